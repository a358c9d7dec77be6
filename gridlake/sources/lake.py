"""Lake readers (A3, A4, A6, A8, A9): Parquet layers with explicit schemas where fixed."""
from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from gridlake import schemas
from gridlake.sinks.batches import read_batches

# What the stream writes.
SCORED = ("event_time timestamp, region string, price_eur_mwh double, expected_price double, z_score double, "
          "anomaly_level string")


def read_bronze(spark: SparkSession, root: str) -> DataFrame:
    """Bronze, Hive-partitioned by year/month; partition values read back as integers."""
    return spark.read.schema(schemas.BRONZE_READ).option("basePath", root).parquet(root)


def read_silver_features(spark: SparkSession, root: str) -> DataFrame:
    """Silver features, partitioned by country/year (partition pruning on both), by their fixed schema."""
    return spark.read.schema(schemas.SILVER_FEATURES).option("basePath", root).parquet(root)


def read_price_profile(spark: SparkSession, root: str) -> DataFrame:
    """The price profile, partitioned by country."""
    return spark.read.schema(schemas.PRICE_PROFILE).option("basePath", root).parquet(root)


def _or_empty(spark: SparkSession, path: str, empty) -> DataFrame:
    """A Parquet table, or an empty frame of the schema ``empty`` where nothing has been written yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as problem:
        if empty is None or problem.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], empty)


def read_gold(spark: SparkSession, gold_root: str, table: str, empty=None) -> DataFrame:
    """A gold table by name (A8). With a schema ``empty``, a table that isn't there reads as no rows."""
    return _or_empty(spark, f"{gold_root.rstrip('/')}/{table}", empty)


def read_realtime(spark: SparkSession, path: str) -> DataFrame:
    """The scored stream: complete batches, and the segments that they were packed into.

    Before the stream has written anything, it reads as no rows.
    """
    return read_batches(spark, path, SCORED)
