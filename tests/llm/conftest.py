"""Fixtures of the corpus operators: a local session with a shared folder, and small frames of awkward rows."""
import os

import pytest
from pyspark.sql import SparkSession

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("GRIDLAKE_DRIVER_MEMORY", "4g"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def texts(spark):
    import duckdb

    return duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()


#: doc_id, text: nulls, empty and blank texts, ties, repeated rows, a long text, non-ASCII and control characters.
AWKWARD = [
    (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "One"), (6, "a b c d e f g"), (6, "a b c d e f g"), (None, "a b c d e f g"),
    (None, None), (7, "naïve café 漢字 😀 \x00 end"), (8, "word " * 4000), (9, "word " * 4001), (10, "x" * 3000), (11, "x" * 3000),
]


@pytest.fixture(scope="session")
def awkward(spark):
    rows = [(i, t, "en", "s", len(t) if t else None, "clash", 0.5, None) for i, t in AWKWARD]
    # columns named like those that operators add, and one of nulls
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string, score double, ids string"
    return spark.createDataFrame(rows, schema).repartition(3)
