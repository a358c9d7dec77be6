"""Hour spine generator (A11): every hour in ``[start, end)``.

Built from ``spark.range`` so the row count is known on the driver before anything runs
(callers use it to decide whether the spine may be broadcast) and the rows are generated in
parallel, however long the spine is.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HOUR = dt.timedelta(hours=1)


def spine_rows(start: dt.datetime, end: dt.datetime) -> int:
    """Number of hours in ``[start, end)`` (DuckDB ``range`` semantics: the end is excluded)."""
    if end <= start:
        return 0
    return -(-(end - start) // HOUR)


def hour_spine(spark: SparkSession, start: dt.datetime, end: dt.datetime, name: str = "date_hour") -> DataFrame:
    n = spine_rows(start, end)
    base = F.lit(start.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    return spark.range(0, n).select((base + F.make_dt_interval(hours=F.col("id"))).alias(name))
