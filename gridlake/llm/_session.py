"""Session helpers of the corpus operators: batch size, the shared folder, written intermediate tables."""
from __future__ import annotations

import contextlib
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Rows per Arrow batch handed to a Python task; bounds a worker's memory for documents of some kB.
BATCH_ROWS = 1000
#: Bytes of such a batch, for tables with long rows (Spark 4.1 and later; a row larger than that is a batch).
BATCH_BYTES = "16m"


def prepare(spark: SparkSession) -> SparkSession:
    """Cap the Arrow batch so that a Python worker holds a few MB of text at a time; give workers this package."""
    _ship(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


_shipped: set[str] = set()
_own_folder: dict[str, str] = {}


def _ship(spark: SparkSession) -> None:
    """Python workers may lack the driver's path: send them the sources, once for each application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    top = Path(__file__).resolve().parents[1]
    packed = Path(tempfile.mkdtemp(prefix="llm-sources-")) / "llm_sources.zip"
    with zipfile.ZipFile(packed, "w") as out:
        for path in sorted(top.rglob("*.py")):
            out.write(path, path.relative_to(top.parent))
    context.addPyFile(str(packed))
    _shipped.add(context.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, shared by the driver and all executors.

    Where it is unset, a folder of this machine serves a local session (as in tests), whose tasks run in the driver;
    a cluster must name one.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if context.master != "local" and not context.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if context.applicationId not in _own_folder:
        _own_folder[context.applicationId] = tempfile.mkdtemp(prefix="llm-shared-")
    return _own_folder[context.applicationId]


#: Tables written within a scope, by its name, and the scopes that are open.
_tables: dict[str, list[str]] = {}
_open: list[str] = []


@contextlib.contextmanager
def scope(name: str) -> Iterator[None]:
    """Tables that are written meanwhile can be dropped by ``drop_tables(name)``."""
    _open.append(name)
    try:
        yield
    finally:
        _open.pop()


def drop_tables(spark: SparkSession, name: str) -> None:
    """Delete the tables that were written in scopes of this name; nothing may need them any more."""
    for path in _tables.pop(name, []):
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def keep_tables(name: str) -> None:
    """From now on the tables of these scopes are the caller's."""
    _tables.pop(name, None)


def written(df: DataFrame, kind: str) -> DataFrame:
    """Cut the lineage: write ``df`` once as Parquet in the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{kind}-{uuid.uuid4().hex}"
    if _open:
        _tables.setdefault(_open[-1], []).append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    return next(n for n in (f"_{stem}{k}" for k in range(len(taken) + 1)) if n.lower() not in taken)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
