"""Re-published prices and their corrections (K9): keyed state with time-out.

The feed sends its whole price list again and again. Per (region, hour), state keeps the price that was passed on last
and the time of its arrival. A message passes if it is the first of its hour, or if it arrived later and its price
differs; an equal price, or an older message that comes late, is dropped. State goes once the watermark of arrival has
passed the last arrival by ``remember``.

State is partitioned by key, so it grows with the hours that are published at a time, not with the messages. It needs
the RocksDB state store, which ``use_state_store`` sets.
"""
from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

KEYS = ["region", "timestamp_ms"]
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# How long a region's price list is published again: day-ahead lists cover two days at most.
REMEMBERED = "48 hours"
_MILLIS = {"second": 1000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}


def use_state_store(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    return spark


def millis(span: str) -> int:
    """``"48 hours"`` in milliseconds."""
    number, unit = span.split()
    return int(number) * _MILLIS[unit.rstrip("s")]


class _Latest(StatefulProcessor):
    def __init__(self, remember_ms: int, columns: list[str]):
        self.remember_ms, self.columns = remember_ms, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "price double, arrival long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = self.last.get() if self.last.exists() else None
        first = known is None
        price, arrival = (None, None) if first else known
        passed = []
        for frame in rows:
            frame, pass_on = frame.sort_values("arrival_ms", kind="stable"), []
            for found, at in zip(frame["price_eur_mwh"], frame["arrival_ms"]):
                own, at = None if pd.isna(found) else float(found), int(at)
                pass_on.append(first or (at >= arrival and own != price))
                if first or at >= arrival:
                    first, price, arrival = False, own, at
            passed.append(frame.loc[pass_on, self.columns])
        self.last.update((price, arrival))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(arrival + self.remember_ms)
        yield from (frame for frame in passed if len(frame))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def latest_prices(points: DataFrame, remember: str = REMEMBERED, keys: list[str] = KEYS) -> DataFrame:
    """Decoded messages (a stream) without re-publications: the first price of each (region, hour) and its corrections.

    Arrival is ``ingested_at``, or the time of processing where it is missing. Within a micro-batch the messages of a key
    are taken by arrival.
    """
    arrival = F.coalesce(F.timestamp_micros((F.col("ingested_at") * 1e6).cast("long")), F.current_timestamp())
    marked = points.withColumn("_arrival", arrival).withWatermark("_arrival", remember).withColumn("arrival_ms", F.unix_millis("_arrival"))
    columns = points.columns
    # one key of text: pandas would turn a number into a double in batches that hold a null
    key = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    return marked.withColumn("state_key", key).groupBy("state_key").transformWithStateInPandas(
        statefulProcessor=_Latest(millis(remember), columns), outputStructType=points.schema, outputMode="Append", timeMode="EventTime")
