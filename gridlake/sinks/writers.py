"""Layer writers (B1–B5, B7, B8). Every write is an overwrite of its own path (idempotent).

None repartitions by its partition columns: one month or one zone may hold a third of the
data, and ``repartition(year, month)`` would hand that third to one task. The ``rebalance``
hint is used instead: adaptive execution joins small parts of a partition and splits large
ones, so files have a sensible size. Rows are sorted within each task by the partition
columns, so each task keeps one open file at a time.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from gridlake.operators import quality
from gridlake.sources.files import Folder


def _partitioned(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.hint("rebalance", *cols).sortWithinPartitions(*cols)


def _month(year, month):
    """A number for a month; its bit in a bitmap is one less, and a bitmap holds 2,700 years."""
    return (F.col(year).cast("int") * 12 + F.col(month).cast("int")).cast("long")


def write_bronze(bronze: DataFrame, root: str) -> None:
    """B1: Parquet partitioned by year/month, replacing what was there.

    Rows go to a staging folder; months are exchanged when all tasks are done, so a run that fails midway leaves the
    former rows as they were. Months that the new rows don't have go last: which ones they have is observed during the
    write, as one bit a month.
    """
    folder, seen = Folder(bronze.sparkSession, root), Observation()
    before = {(y, m) for y in folder.folders() if y.startswith("year=") for m in folder.folders(y) if m.startswith("month=")}
    months = F.bitmap_construct_agg(F.bitmap_bit_position(_month("year", "month")))
    parts = _partitioned(bronze.observe(seen, months.alias("months"), F.count_if(F.col("year").isNull() | F.col("month").isNull()).alias("without")), ["year", "month"])
    parts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "month").parquet(root)
    found = seen.get if before else {}

    def has_rows(year: str, month: str) -> bool:
        year, month = year.partition("=")[2], month.partition("=")[2]
        if not year.isdigit() or not month.isdigit():  # the partition of rows without a time
            return found["without"] > 0
        at = (int(year) * 12 + int(month) - 1) % (8 * len(found["months"]))
        return found["months"][at // 8] >> at % 8 & 1 == 1

    for name in sorted(before):
        if not has_rows(*name):
            folder.delete(*name)


def write_silver_features(features: DataFrame, root: str) -> None:
    """B2: partitioned by country/year."""
    _partitioned(features, ["country", "year"]).write.mode("overwrite").partitionBy("country", "year").parquet(root)


def write_price_profile(profile: DataFrame, root: str) -> None:
    """Partitioned by country."""
    _partitioned(profile, ["country"]).write.mode("overwrite").partitionBy("country").parquet(root)


def write_gold(df: DataFrame, gold_root: str, table: str, partition_by: list[str] | None = None) -> None:
    """One Parquet table per model; the hourly fact keeps partition pruning by year."""
    path = f"{gold_root.rstrip('/')}/{table}"
    writer = (_partitioned(df, partition_by) if partition_by else df).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def publish_messages(points: DataFrame, ingested_at=None) -> DataFrame:
    """Price points -> one UTF-8 JSON ``value`` per message.

    ``ingested_at`` defaults to the processing time in epoch seconds (injectable for tests).
    """
    if ingested_at is None:
        ingested = F.unix_micros(F.current_timestamp()) / F.lit(1e6)
    elif isinstance(ingested_at, Column):
        ingested = ingested_at.cast("double")
    else:
        ingested = F.lit(ingested_at).cast("double")
    message = F.struct(
        F.col("start_timestamp").alias("timestamp_ms"),
        F.col("marketprice").alias("price_eur_mwh"),
        F.col("unit"),
        F.col("region"),
        ingested.alias("ingested_at"),
    )
    return points.select(F.col("region").alias("key"), F.to_json(message).alias("value"))


def write_topic(messages: DataFrame, servers: str, topic: str) -> None:
    """B7 sink: Kafka-protocol topic (needs the Kafka connector on the classpath)."""
    messages.selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value").write.format("kafka") \
        .option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def snapshot_rows(points: DataFrame, ingestion_time=None) -> DataFrame:
    """B8 rows: the payload points plus ``ingestion_time`` (ISO text) and ``snapshot_date`` (yyyyMMdd)."""
    ts = F.lit(ingestion_time).cast("timestamp") if ingestion_time is not None else F.current_timestamp()
    return points.select(
        "start_timestamp", "end_timestamp", "marketprice", "unit", "region",
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ingestion_time"),
        F.date_format(ts, "yyyyMMdd").alias("snapshot_date"),
    )


def write_snapshot(rows: DataFrame, root: str) -> None:
    """CSV with header under ``region=…/snapshot_date=…``."""
    _partitioned(rows, ["region", "snapshot_date"]).write.mode("overwrite").option("header", True) \
        .partitionBy("region", "snapshot_date").csv(root)


def write_report(report: DataFrame, path: str) -> None:
    report.select(*quality.REPORT_COLUMNS).coalesce(1).write.mode("overwrite").parquet(path)
