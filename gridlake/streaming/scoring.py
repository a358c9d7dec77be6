"""Live price scoring.

``score`` is a pure DataFrame function, so the same plan runs on a static frame (tests,
backfills, the registered query) and on each micro-batch (``start_scoring``). The stream is
stateless per row unless de-duplication is switched on (K9).
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake import schemas
from gridlake.functions.semantics import anomaly_level, dow, region_to_zone
from gridlake.operators.gold import with_cells
from gridlake.sinks.batches import write_batch
from gridlake.streaming.corrections import KEYS, REMEMBERED, latest_prices
from gridlake.streaming.lookup import Fixed, Refreshed

LOOKUP_KEYS = ["country_code", "month_of_year", "day_of_week", "hour_of_day"]
UTC_NAMES = {"utc", "etc/utc", "z", "gmt", "+00:00", "universal", "zulu"}


def decode(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Carrier frame (binary or string ``value``) -> message fields (K1).

    Malformed JSON yields a row whose fields are all NULL; ``split_bad`` separates those.
    """
    text = F.col(value_col).cast("string")
    return raw.select(F.from_json(text, schemas.STREAM_MESSAGE).alias("m"), text.alias("record")).select("m.*", "record")


def split_bad(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad): rows without an event time cannot be scored and go to a dead-letter output."""
    bad = F.col("timestamp_ms").isNull()
    return decoded.where(~bad).drop("record"), decoded.where(bad).select(F.col("record").alias("value"))


def baseline_lookup(baselines: DataFrame) -> DataFrame:
    """Distinct keys with their mean and σ, from ``fct_price_baselines``."""
    stats = [F.col("avg_price_baseline").alias("usual"), F.col("stddev_price_baseline").alias("spread")]
    return baselines.select(*LOOKUP_KEYS, *stats).distinct()


def score(points: DataFrame, baselines: DataFrame, mean_factor: float = 1.0, std_factor: float = 1.0,
          zones: int | None = None) -> DataFrame:
    """Score decoded price messages against the historical baselines.

    Event time is an instant (``timestamp_millis``); under the UTC session its month, hour
    and weekday (1 = Sunday … 7 = Saturday) equal the batch profile's keys. ``zones``, the
    number of zones where it is known, lets the baselines be looked up by index in one array
    a zone (``gold.with_cells``). Raises in a session of another time zone (S3), where keys
    would match the wrong cells.
    """
    zone = points.sparkSession.conf.get("spark.sql.session.timeZone")
    if zone.lower() not in UTC_NAMES:
        raise ValueError(f"scoring needs a session in UTC (spark.sql.session.timeZone), not {zone}")
    event_time = F.timestamp_millis(F.col("timestamp_ms"))
    keyed = points.where(F.col("timestamp_ms").isNotNull()).select(
        "*",
        event_time.alias("event_time"),
        F.month(event_time).alias("month_of_year"),
        dow(event_time).alias("day_of_week"),
        F.hour(event_time).alias("hour_of_day"),
        region_to_zone("region").alias("country_code"),
    )
    enriched = with_cells(keyed, baseline_lookup(baselines), ["usual", "spread"], zones, how="left")
    scaled_mean = F.col("usual") * F.lit(mean_factor)
    scaled_std = F.col("spread") * F.lit(std_factor)
    z = (F.col("price_eur_mwh") - scaled_mean) / F.nullif(scaled_std, F.lit(0.0))
    return enriched.select(
        "event_time",
        "region",
        "price_eur_mwh",
        scaled_mean.alias("expected_price"),
        z.alias("z_score"),
        anomaly_level(z).alias("anomaly_level"),
    )


def drop_republished(points: DataFrame, remember: str = REMEMBERED, keys: list[str] = KEYS) -> DataFrame:
    """Optional K9: the producer re-sends its whole price list; keep the first copy of each (region, hour).

    The watermark follows the time of arrival (``ingested_at``, else the time of processing), not the hour that a price
    is for: a list spans a day, so a region whose first list comes after others would lose its early hours. A copy is
    known for ``remember`` after its first arrival; a price that arrives later than others by that much is late.
    """
    arrival = F.timestamp_micros((F.col("ingested_at") * 1e6).cast("long"))
    return (
        points.withColumn("_arrival", F.coalesce(arrival, F.current_timestamp()))
        .withWatermark("_arrival", remember)
        .dropDuplicatesWithinWatermark(keys)
        .drop("_arrival")
    )


def _without_copies(decoded: DataFrame, latest: bool) -> DataFrame:
    """De-duplicated messages. A malformed record has no key: a tie of its own keeps it apart from all others."""
    marked = decoded.withColumn("tie", F.when(F.col("timestamp_ms").isNull(), F.expr("uuid()")).otherwise(""))
    drop = latest_prices if latest else drop_republished
    return drop(marked, keys=[*KEYS, "tie"]).drop("tie")


def start_scoring(source: DataFrame, baselines: DataFrame | str, path: str, checkpoint: str,
                  trigger: dict | None = None, dedupe: bool | str = False, dead_letter_path: str | None = None,
                  mean_factor: float = 1.0, std_factor: float = 1.0, query_name: str | None = None):
    """Run the scoring stream: source (any frame with a ``value`` column) -> batches of a table.

    One query reads the source once. Each micro-batch is split into scored rows, written below ``path``, and malformed
    records, written below ``dead_letter_path``; both writes replace the folder of the batch id, so a batch that is run
    again after a failure leaves each row once (``sinks.batches``; read with ``lake.read_realtime``).

    ``baselines`` is a frame, or the folder of a versioned lookup (``streaming.lookup``): before each batch its last
    version is asked for, and scores follow it. The lookup is kept in memory between batches.

    ``dedupe``: ``True`` or ``"first"`` keeps the first copy of a re-published price, ``"latest"`` lets corrected prices
    through as well (``streaming.corrections``). ``trigger`` defaults to a 10-second micro-batch; pass
    ``{"availableNow": True}`` for backfills and tests. The checkpoint must live on shared storage
    (``gridlake.session.checkpoint_root``).
    """
    lookup = Refreshed(baselines) if isinstance(baselines, str) else Fixed(baselines)
    decoded = decode(source)
    if dedupe:
        decoded = _without_copies(decoded, latest=dedupe == "latest")

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            good, bad = split_bad(kept)
            scored = score(good, lookup.current(batch.sparkSession), mean_factor, std_factor, zones=lookup.zones)
            write_batch(scored, path, batch_id)
            if dead_letter_path:
                write_batch(bad, dead_letter_path, batch_id)
        finally:
            kept.unpersist()

    writer = (
        decoded.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{checkpoint.rstrip('/')}/scores")
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
    )
    if query_name:
        writer = writer.queryName(query_name)
    return [writer.start()]
