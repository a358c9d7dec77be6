"""Session helpers. Jobs never build their own session; callers pass one in."""
from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings every gridlake job relies on (see SURVEY §8 S1, S3).
REQUIRED_CONF = {
    # batch (NTZ) and stream (instant) calendar parts must agree
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings gridlake needs to an existing session."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster (``spark.checkpoint.dir``); streams keep their checkpoints there.

    There is no fallback: a folder of one machine would lose part of what executors write.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not named:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return named.rstrip("/")


def local_session(cores: int | str = 8, app: str = "gridlake", shuffle_partitions: int | None = None) -> SparkSession:
    """A local session for tests and the bench (never used by library code)."""
    parts = shuffle_partitions or (int(cores) if str(cores).isdigit() else 8)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.default.parallelism", str(parts))
        .config("spark.driver.memory", os.environ.get("GRIDLAKE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in REQUIRED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
