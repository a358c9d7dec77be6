"""Wide file -> bronze long table.

Everything is narrow (no shuffle): the unpivot, the regex split of the column name, the
timestamp parse and the cast run per row inside one codegen stage after the scan.
"""
from __future__ import annotations

import re

from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from gridlake.sources.wide_csv import TIMESTAMP_COLUMN, discover_zones, null_tokens_to_null, zone_columns


def zone_pattern(zones: list[str]) -> str:
    """Anchored alternation, longest zone first, so ``IT_NORD_AT_x`` is zone ``IT_NORD_AT`` (C4)."""
    ordered = sorted(zones, key=len, reverse=True)
    return "^(" + "|".join(re.escape(z) for z in ordered) + ")_"


def to_long(wide: DataFrame, zones: list[str] | None = None, seen: Observation | None = None) -> DataFrame:
    """All-string wide frame -> bronze rows ``timestamp, country, metric_name, value, year, month``.

    Zones come from the header when not given (C1). Cells that are NULL tokens, empty or not
    numbers become NULL (``try_cast``) and are dropped with the other NULL measurements (C9).
    ``seen`` observes ``cells`` and ``unparsable_cells`` (text that is neither a number nor a
    NULL token, S4) while the rows are written, so that they need no scan of their own.
    """
    zones = zones or discover_zones(wide.columns)
    parsed = _parsed(wide, zones)
    return _kept(parsed if seen is None else _observed(parsed, seen))


def to_long_all(wides: list[tuple[list[str], DataFrame]], seen: Observation | None = None) -> DataFrame:
    """Bronze rows of files with different headers (``wide_csv.read_wide_all``), each by its own zones (A1)."""
    parsed = reduce(DataFrame.union, [_parsed(wide, zones) for zones, wide in wides])
    return _kept(parsed if seen is None else _observed(parsed, seen))


def _parsed(wide: DataFrame, zones: list[str]) -> DataFrame:
    values = zone_columns(wide.columns, zones)
    pattern = zone_pattern(zones)
    cleaned = null_tokens_to_null(wide.select(TIMESTAMP_COLUMN, *values), values)
    long = cleaned.unpivot([TIMESTAMP_COLUMN], values, "raw_col_name", "raw_value")
    ts_text = F.regexp_replace(F.regexp_replace(F.col(TIMESTAMP_COLUMN), "Z$", ""), "T", " ")
    value = F.col("raw_value").try_cast("double")
    return long.select(
        F.to_timestamp_ntz(ts_text, F.lit("yyyy-MM-dd HH:mm:ss")).alias("timestamp"),
        F.regexp_extract("raw_col_name", pattern, 1).alias("country"),
        F.regexp_replace("raw_col_name", pattern, "").alias("metric_name"),
        value.alias("value"),
        (F.col("raw_value").isNotNull() & value.isNull()).alias("unparsable"),
    )


def _observed(parsed: DataFrame, seen: Observation) -> DataFrame:
    return parsed.observe(seen, F.count(F.lit(1)).alias("cells"), F.count_if("unparsable").alias("unparsable_cells"))


def _kept(parsed: DataFrame) -> DataFrame:
    return parsed.drop("unparsable").where(F.col("value").isNotNull()).withColumns(
        {
            "year": F.year("timestamp").cast("string"),
            "month": F.lpad(F.month("timestamp").cast("string"), 2, "0"),
        }
    )


def unparsable_cells(wide: DataFrame, zones: list[str] | None = None) -> DataFrame:
    """Count of non-empty, non-token cells that are not numbers, per column."""
    zones = zones or discover_zones(wide.columns)
    values = zone_columns(wide.columns, zones)
    cleaned = null_tokens_to_null(wide.select(*values), values)
    return cleaned.agg(
        *[F.count_if(F.col(c).isNotNull() & F.col(c).try_cast("double").isNull()).alias(c) for c in values]
    )
