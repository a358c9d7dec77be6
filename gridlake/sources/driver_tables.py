"""Adapter from the driver's generic tables to the energy domain.

The driver ships no market data, so the ``events`` table plays the measurement feed:
one event is one measurement. Every function here is a narrow, row-wise projection (no
shuffle), so the adapted data grows exactly with ``events``.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake import schemas
from gridlake.sources.wide_csv import TIMESTAMP_COLUMN

# The adapter's mappings.
# zone chosen by user_id % 5, in this order
ZONES = ["DE_LU", "AT", "DK_1", "NO_2", "SE_1"]
# event type -> metric name of the wide file; "error_count" is a metric silver ignores
EVENT_METRICS = {
    "view": "price_day_ahead",
    "click": "load_actual_entsoe_transparency",
    "purchase": "solar_generation_actual",
    "signup": "wind_generation_actual",
    "error": "error_count",
}
LOAD_SCALE = 50.0           # click values are scaled so renewable shares straddle 0.1
PRICE_EVENT = "view"        # events that are also live price quotes
PRICE_UNIT = "Eur/MWh"
# zone -> producer region (the stream maps DE back to DE_LU)
ZONE_REGION = {"DE_LU": "DE"}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(col: Column, mapping: dict) -> Column:
    expr = None
    for key, value in mapping.items():
        expr = F.when(col == key, F.lit(value)) if expr is None else expr.when(col == key, F.lit(value))
    return expr


def zone_of(user_id: Column) -> Column:
    """Zone by ``user_id % 5``: remainders 0 to 3 name the first four, any other one (negative ids too) the last.

    NULL for a NULL id. One lookup in a literal array.
    """
    zones = F.array(*[F.lit(z) for z in ZONES])
    remainder = (user_id % len(ZONES)).cast("int")
    last = len(ZONES) - 1
    return F.try_element_at(zones, F.when(remainder < 0, last).otherwise(remainder) + 1)


def metric_of(event_type: Column) -> Column:
    """Metric name by event type (NULL when unmapped): one lookup in a literal map."""
    mapping = F.create_map(*[F.lit(x) for kv in EVENT_METRICS.items() for x in kv])
    return F.try_element_at(mapping, event_type)


def hour_of(ts: Column) -> Column:
    """Event time truncated to the hour, kept naive (``date_trunc`` returns an instant)."""
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def measured_value(event_type: Column, value: Column) -> Column:
    return F.when(event_type == "click", value * F.lit(LOAD_SCALE)).otherwise(value)


def bronze_from_events(events: DataFrame) -> DataFrame:
    """events -> bronze long rows (contract of ``schemas.BRONZE``), one row per event."""
    ts = hour_of(F.col("ts"))
    return (
        events.select(
            ts.alias("timestamp"),
            zone_of(F.col("user_id")).alias("country"),
            metric_of(F.col("event_type")).alias("metric_name"),
            measured_value(F.col("event_type"), F.col("value")).alias("value"),
        )
        .where(F.col("timestamp").isNotNull() & F.col("country").isNotNull()
               & F.col("metric_name").isNotNull() & F.col("value").isNotNull())
        .withColumns({
            "year": F.year("timestamp").cast("string"),
            "month": F.lpad(F.month("timestamp").cast("string"), 2, "0"),
        })
    )


def wide_columns() -> list[str]:
    """Header of the CSV-shaped frame: ``{zone}_{metric}`` for every zone and metric."""
    return [f"{z}_{m}" for z in ZONES for m in EVENT_METRICS.values()]


def wide_from_events(events: DataFrame) -> DataFrame:
    """events -> the wide file shape: one row per hour, all-string cells.

    ``utc_timestamp`` is ISO text with a ``Z``; each cell is the hour's mean of that zone's
    metric, written as text (NULL where the hour has none), as a CSV reader would see it.
    """
    cols = wide_columns()
    keyed = events.select(
        F.date_format(hour_of(F.col("ts")), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias(TIMESTAMP_COLUMN),
        F.concat_ws("_", zone_of(F.col("user_id")), metric_of(F.col("event_type"))).alias("column"),
        measured_value(F.col("event_type"), F.col("value")).alias("value"),
    )
    wide = keyed.groupBy(TIMESTAMP_COLUMN).pivot("column", cols).agg(F.avg("value"))
    return wide.select(TIMESTAMP_COLUMN, *[F.col(c).cast("string").alias(c) for c in cols])


def region_of(zone: Column) -> Column:
    expr = None
    for z, region in ZONE_REGION.items():
        expr = F.when(zone == z, F.lit(region)) if expr is None else expr.when(zone == z, F.lit(region))
    return expr.otherwise(zone)


def price_quotes(events: DataFrame) -> DataFrame:
    """Price events as live quotes: (region, timestamp_ms, price_eur_mwh, unit, ingested_at).

    A quote is for the hour its event falls in; ``ingested_at`` is the event's own time in
    epoch seconds.
    """
    return events.where(F.col("event_type") == PRICE_EVENT).select(
        region_of(zone_of(F.col("user_id"))).alias("region"),
        F.unix_millis(hour_of(F.col("ts")).cast("timestamp")).alias("timestamp_ms"),
        F.col("value").alias("price_eur_mwh"),
        F.lit(PRICE_UNIT).alias("unit"),
        (F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6)).alias("ingested_at"),
    )


def payload_lists(events: DataFrame) -> DataFrame:
    """Landed API documents of many points: the quotes of a region that arrived in one minute make a list.

    Columns: (region, payload). A minute of one region is a small group, however many events there are in all.
    """
    start = F.unix_millis(hour_of(F.col("ts")).cast("timestamp"))
    point = F.struct(start.alias("start_timestamp"), (start + F.lit(3_600_000)).alias("end_timestamp"),
                     F.col("value").alias("marketprice"), F.lit(PRICE_UNIT).alias("unit"))
    quotes = events.where(F.col("event_type") == PRICE_EVENT).select(
        region_of(zone_of(F.col("user_id"))).alias("region"), F.date_trunc("minute", "ts").alias("minute"), point.alias("point"))
    lists = quotes.where(F.col("region").isNotNull()).groupBy("region", "minute").agg(F.collect_list("point").alias("data"))
    return lists.select("region", F.to_json(F.struct("data")).alias("payload"))


def payload_documents(events: DataFrame) -> DataFrame:
    """One landed API document per event: ``{"data": [point]}`` for price events and
    ``{"data": []}`` for the others. Columns: (event_id, region, payload)."""
    start = F.unix_millis(hour_of(F.col("ts")).cast("timestamp"))
    point = F.struct(
        start.alias("start_timestamp"),
        (start + F.lit(3_600_000)).alias("end_timestamp"),
        F.col("value").alias("marketprice"),
        F.lit(PRICE_UNIT).alias("unit"),
    )
    points = F.when(F.col("event_type") == PRICE_EVENT, F.array(point)).otherwise(
        F.array().cast(schemas.PAYLOAD["data"].dataType)
    )
    return events.select(
        "event_id",
        region_of(zone_of(F.col("user_id"))).alias("region"),
        F.to_json(F.struct(points.alias("data"))).alias("payload"),
    )
