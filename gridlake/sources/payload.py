"""Landed price-API payloads (A10): ``{"data": [{start_timestamp, end_timestamp, marketprice, unit}]}``.

One document per file or per row; an empty or missing ``data`` yields no rows.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake import schemas


def read_payload(spark: SparkSession, path: str, region: str | None = None) -> DataFrame:
    """Read landed JSON documents (multi-line) with the fixed payload schema."""
    df = spark.read.schema(schemas.PAYLOAD).option("multiLine", True).json(path)
    return df.withColumn("region", F.lit(region)) if region is not None else df


def parse_payload(docs: DataFrame, column: str = "payload") -> DataFrame:
    """JSON text column -> ``data`` array column (other columns kept)."""
    return docs.withColumn("data", F.from_json(F.col(column), schemas.PAYLOAD)["data"]).drop(column)


def price_points(payload: DataFrame) -> DataFrame:
    """One row per price point, with event time, price, hour and month (A10).

    ``explode`` (not ``explode_outer``) so empty and NULL arrays produce no rows.
    """
    keep = [c for c in payload.columns if c != "data"]
    points = payload.select(*keep, F.explode("data").alias("p")).select(*keep, "p.*")
    event_time = F.timestamp_millis(F.col("start_timestamp"))
    return points.select(
        *keep,
        "start_timestamp",
        "end_timestamp",
        "marketprice",
        "unit",
        event_time.alias("event_time"),
        F.col("marketprice").alias("price_eur_mwh"),
        F.hour(event_time).alias("hour"),
        F.month(event_time).alias("month"),
    )
