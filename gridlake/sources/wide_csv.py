"""Wide measurement CSV: header probe (A1), zone discovery (C1), null-token scan (A2)."""
from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.sources.files import Folder

TIMESTAMP_COLUMN = "utc_timestamp"
PRICE_SUFFIX = "_price_day_ahead"
# Text that means "no measurement" in the wide files (plus the empty cell).
NULL_TOKENS = ("NA", "nan", "-")

_PRICE_COLUMN = re.compile(r"^(.+)" + re.escape(PRICE_SUFFIX) + r"$")


class NoPriceColumnsError(ValueError):
    pass


def discover_zones(columns: list[str]) -> list[str]:
    """Zones are the prefixes of ``{zone}_price_day_ahead`` columns, sorted and distinct.

    Pure metadata (header names only, no data); raises when the header has no price column.
    """
    zones = sorted({m.group(1) for m in map(_PRICE_COLUMN.match, columns) if m})
    if not zones:
        raise NoPriceColumnsError("No price columns found in the header; cannot determine the zones")
    return zones


def zone_columns(columns: list[str], zones: list[str]) -> list[str]:
    """Measurement columns that belong to a discovered zone (C2), header order kept."""
    prefixes = tuple(f"{z}_" for z in zones)
    return [c for c in columns if c != TIMESTAMP_COLUMN and c.startswith(prefixes)]


def header(spark: SparkSession, path: str) -> list[str]:
    """Column names from the header line only (A1): no schema inference, no data job."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path).columns


def null_tokens_to_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """Listed tokens and empty cells become NULL; applied to the all-string columns (A2)."""
    return df.withColumns(
        {c: F.when(F.trim(F.col(c)).isin(*NULL_TOKENS) | (F.trim(F.col(c)) == ""), None).otherwise(F.col(c))
         for c in columns}
    )


def read_wide(spark: SparkSession, path: str) -> DataFrame:
    """Scan the wide CSV as all-string columns (schema from the header, nothing inferred).

    Only the timestamp and the discovered zones' columns are kept, so the long form never
    carries columns of zones without a price.
    """
    cols = header(spark, path)
    zones = discover_zones(cols)
    keep = [TIMESTAMP_COLUMN] + zone_columns(cols, zones)
    raw = spark.read.option("header", True).option("inferSchema", False).option("mode", "PERMISSIVE").csv(path)
    return raw.select(*keep)


def is_folder(spark: SparkSession, path: str) -> bool:
    return Folder(spark, path).is_folder()


def files_by_header(spark: SparkSession, folder: str, suffix: str = ".csv") -> list[list[str]]:
    """The files of a folder, those with the same header line together, in the order of their names (A1).

    Only first lines are read, one file after another.
    """
    found = Folder(spark, folder)
    groups: dict[str, list[str]] = {}
    for path in found.data_files(suffix):
        groups.setdefault(found.first_line(path).strip(), []).append(path)
    return list(groups.values())


def read_wide_all(spark: SparkSession, folder: str, suffix: str = ".csv") -> list[tuple[list[str], DataFrame]]:
    """A folder of wide files whose columns differ in order and number: (zones, frame) for each different header.

    Columns are matched by name within their own header, and each header decides its own zones, as if its files were read
    alone; a header without a price column is an error, as it is for a single file. Files of one header are one scan, so
    the plan grows with the number of different headers, not of files.
    """
    groups = files_by_header(spark, folder, suffix)
    if not groups:
        raise NoPriceColumnsError(f"No price columns found: no {suffix} files in {folder}")
    out = []
    for paths in groups:
        raw = spark.read.option("header", True).option("inferSchema", False).option("mode", "PERMISSIVE").csv(paths)
        zones = discover_zones(raw.columns)
        out.append((zones, raw.select(TIMESTAMP_COLUMN, *zone_columns(raw.columns, zones))))
    return out
