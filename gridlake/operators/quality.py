"""Data-quality checks as Spark jobs.

Every check returns rows ``(check, table, column, severity, failing_rows, passed)`` so
that ``report`` is a plain union. Each check is one aggregation over its table (partial
aggregation first, so a hot key never reaches one task whole); nothing is collected.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake.operators.gold import maybe_broadcast

REPORT = T.StructType(
    [
        T.StructField("check", T.StringType(), False),
        T.StructField("table", T.StringType(), False),
        T.StructField("column", T.StringType(), True),
        T.StructField("severity", T.StringType(), False),
        T.StructField("failing_rows", T.LongType(), False),
        T.StructField("passed", T.BooleanType(), False),
    ]
)
REPORT_COLUMNS = [f.name for f in REPORT.fields]

# Bronze contract, size warning, and metric keywords of the post-load check.
BRONZE_REQUIRED = ["timestamp", "country", "metric_name", "value", "year", "month"]
MIN_BRONZE_ROWS = 1_000_000
METRIC_KEYWORDS = ["price", "load", "generation"]
CRITICAL_COLUMNS = ["country", "timestamp", "value"]
SUBZONE_PREFIX = "SE_"
SUBZONE_EXPECTED = "SE_1"


def _row(check: str, table: str, column: str | None, severity: str, failing) -> list:
    failing = F.coalesce(failing.cast("long"), F.lit(0).cast("long"))
    return [
        F.lit(check).alias("check"),
        F.lit(table).alias("table"),
        F.lit(column).cast("string").alias("column"),
        F.lit(severity).alias("severity"),
        failing.alias("failing_rows"),
        (failing == 0).alias("passed"),
    ]


def unique(df: DataFrame, table: str, column: str, severity: str = "error") -> DataFrame:
    """Number of non-NULL values that occur more than once (F1)."""
    dupes = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return dupes.agg(*_row("unique", table, column, severity, F.count_if(F.col("n") > 1)))


def _stacked(one_row: DataFrame, rows: list[tuple]) -> DataFrame:
    """Report rows from a frame of one row: (check, table, column, severity, name of the failing count)."""
    text = lambda x: "CAST(NULL AS STRING)" if x is None else "'" + x.replace("'", "\\'") + "'"
    cells = ", ".join(f"{text(c)}, {text(t)}, {text(col)}, {text(sev)}, coalesce(CAST(`{n}` AS BIGINT), 0L)" for c, t, col, sev, n in rows)
    stacked = one_row.selectExpr(f"stack({len(rows)}, {cells}) AS (`check`, `table`, `column`, severity, failing_rows)")
    return stacked.withColumn("passed", F.col("failing_rows") == 0)


def not_null(df: DataFrame, table: str, columns: list[str] | dict[str, str], severity: str = "error") -> DataFrame:
    """NULL count per column, all columns in one pass (F2, F3, F9). A dict names a severity for each column."""
    each = columns if isinstance(columns, dict) else dict.fromkeys(columns, severity)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(each)])
    return _stacked(counts, [("not_null", table, c, sev, f"n{i}") for i, (c, sev) in enumerate(each.items())])


def key(df: DataFrame, table: str, column: str, others: dict[str, str] | None = None, severity: str = "error") -> DataFrame:
    """A key is unique and not NULL (F1, F2), and other columns are not NULL, from one pass over the table."""
    others = others or {}
    by_key = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(others)])
    null = F.col(column).isNull()
    one = by_key.agg(F.count_if((F.col("n") > 1) & ~null).alias("twice"), F.sum(F.when(null, F.col("n")).otherwise(0)).alias("nulls"),
                     *[F.sum(f"n{i}").alias(f"n{i}") for i in range(len(others))])
    return _stacked(one, [("unique", table, column, severity, "twice"), ("not_null", table, column, severity, "nulls"),
                          *[("not_null", table, c, sev, f"n{i}") for i, (c, sev) in enumerate(others.items())]])


def hours_by_part(df: DataFrame, zone: str, ts: str, parts: list[str]) -> DataFrame:
    """For each part of a table (its partition columns and the zone): rows, hours, rows off the hour, rows without a key.

    One row an hour and zone is the key of the hourly tables, and a part holds all rows of its zone and year. So the key is
    unique if each part has as many rows as hours. Hours are marked in bitmaps (4 kB for 32,768 hours) where the rows are
    read; what is shuffled is a bitmap for each task and part, never a key.
    """
    hour = F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / 3600)
    key = F.col(zone).isNotNull() & F.col(ts).isNotNull()
    marked = df.select(*[F.col(p).alias(f"part_{i}") for i, p in enumerate(parts)], F.col(zone).alias("zone"), key.alias("has_key"), hour.alias("hour"),
                       (F.date_trunc("hour", ts).cast("timestamp_ntz") != F.col(ts).cast("timestamp_ntz")).alias("off"))
    by = [f"part_{i}" for i in range(len(parts))] + ["zone"]
    bucket = F.when(F.col("has_key"), F.bitmap_bucket_number("hour"))
    one = marked.groupBy(*by, bucket.alias("bucket")).agg(
        F.count_if("has_key").alias("rows"), F.count_if(F.col("has_key") & F.col("off")).alias("off_hour"), F.count_if(~F.col("has_key")).alias("without"),
        F.bitmap_count(F.bitmap_construct_agg(F.when(F.col("has_key"), F.bitmap_bit_position("hour")))).alias("hours"))
    total = one.groupBy(*by).agg(*[F.sum(c).alias(c) for c in ("rows", "hours", "off_hour", "without")])
    return total.select(*[F.col(f"part_{i}").alias(p) for i, p in enumerate(parts)], F.col("zone").alias(zone), "rows", "hours", "off_hour", "without")


def key_by_part(df: DataFrame, table: str, column: str, zone: str, ts: str, parts: list[str], others: dict[str, str] | None = None,
                severity: str = "error") -> DataFrame:
    """The checks of ``key`` for a table of hours that is written in parts of whole years: ``column`` is made of the zone
    and the hour, so it is unique if no part has more rows than hours, and no exchange is by key (F1, F2).

    Failing rows of ``unique`` are those beyond the first of their key, and rows whose time isn't a whole hour.
    """
    others = others or {}
    by_part = hours_by_part(df, zone, ts, parts).agg((F.sum("rows") - F.sum("hours") + F.sum("off_hour")).alias("twice"))
    nulls = df.agg(F.count_if(F.col(column).isNull()).alias("nulls"), *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(others)])
    return _stacked(by_part, [("unique", table, column, severity, "twice")]).unionByName(
        _stacked(nulls, [("not_null", table, column, severity, "nulls"), *[("not_null", table, c, sev, f"n{i}") for i, (c, sev) in enumerate(others.items())]]))


def relationship(child: DataFrame, table: str, column: str, parent: DataFrame, parent_column: str,
                 severity: str = "error", parent_rows: int | None = None) -> DataFrame:
    """Child rows whose non-NULL key is missing from the parent."""
    keys = parent.select(F.col(parent_column).alias(column)).distinct()
    keys = maybe_broadcast(keys, parent_rows)
    orphans = child.where(F.col(column).isNotNull()).select(column).join(keys, column, "left_anti")
    return orphans.agg(*_row("relationships", table, column, severity, F.count(F.lit(1))))


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """The orphan keys themselves with their row counts (D7 detail)."""
    keys = parent.select(F.col(parent_column).alias(column)).distinct()
    return (
        child.where(F.col(column).isNotNull()).join(keys, column, "left_anti")
        .groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    )


def columns_present(spark: SparkSession, df: DataFrame, table: str, required: list[str] = BRONZE_REQUIRED,
                    severity: str = "error") -> DataFrame:
    """Required columns missing from the schema (F5): metadata only, no data job."""
    missing = [c for c in required if c not in df.columns]
    return spark.createDataFrame([("columns_present", table, ",".join(missing) or None, severity,
                                   len(missing), not missing)], REPORT)


def min_rows(df: DataFrame, table: str, minimum: int = MIN_BRONZE_ROWS, severity: str = "warn") -> DataFrame:
    """Rows short of ``minimum``."""
    short = F.greatest(F.lit(minimum) - F.count(F.lit(1)), F.lit(0))
    return df.agg(*_row("min_rows", table, None, severity, short))


def zone_set_diff(actual: DataFrame, target: DataFrame, column: str = "country") -> DataFrame:
    """(zone, status): zones in the data but not the target are ``unexpected``; the reverse
    ``missing`` (D8). Two anti joins over distinct zones."""
    a = actual.select(F.col(column).alias("zone")).where(F.col("zone").isNotNull()).distinct()
    t = target.select(F.col(column).alias("zone")).where(F.col("zone").isNotNull()).distinct()
    return (
        a.join(t, "zone", "left_anti").withColumn("status", F.lit("unexpected"))
        .unionByName(t.join(a, "zone", "left_anti").withColumn("status", F.lit("missing")))
    )


def zone_match(actual: DataFrame, target: DataFrame, table: str, column: str = "country") -> DataFrame:
    """Unexpected zones fail, missing zones warn."""
    diff = zone_set_diff(actual, target, column)
    return diff.agg(*_row("zones_unexpected", table, column, "error", F.count_if(F.col("status") == "unexpected"))) \
        .unionByName(diff.agg(*_row("zones_missing", table, column, "warn", F.count_if(F.col("status") == "missing"))))


def keywords(df: DataFrame, table: str, column: str = "metric_name", words: list[str] = METRIC_KEYWORDS,
             severity: str = "warn") -> DataFrame:
    """Keywords that no metric name contains (F8); one pass with ``bool_or`` per keyword."""
    found = df.agg(*[F.bool_or(F.col(column).contains(w)).alias(f"k{i}") for i, w in enumerate(words)])
    missing = sum((F.when(F.coalesce(F.col(f"k{i}"), F.lit(False)), 0).otherwise(1) for i in range(len(words))),
                  F.lit(0))
    return found.select(*_row("metric_keywords", table, column, severity, missing))


def subzone_check(df: DataFrame, table: str, column: str = "country", prefix: str = SUBZONE_PREFIX,
                  expected: str = SUBZONE_EXPECTED, severity: str = "warn") -> DataFrame:
    """Warn when no zone starts with ``prefix`` or ``expected`` is absent."""
    agg = df.agg(F.count_if(F.col(column).startswith(prefix)).alias("p"), F.count_if(F.col(column) == expected).alias("e"))
    failing = F.when(F.col("p") == 0, 1).otherwise(0) + F.when(F.col("e") == 0, 1).otherwise(0)
    return agg.select(*_row("subzones", table, column, severity, failing))


def bronze_checks(bronze: DataFrame, table: str, target_zones: list[str] | None = None, minimum: int = MIN_BRONZE_ROWS,
                  words: list[str] = METRIC_KEYWORDS, columns: list[str] = CRITICAL_COLUMNS) -> DataFrame:
    """All checks of bronze rows (F6–F10) from one scan: rows and NULLs are counted by zone and metric first (a handful
    of groups, summed before the shuffle), and the checks read these counts alone."""
    counted = bronze.groupBy("country", "metric_name").agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns])
    has = lambda test: F.coalesce(F.bool_or(test), F.lit(False))
    missing = sum((F.when(has(F.col("metric_name").contains(w)), 0).otherwise(1) for w in words), F.lit(0))
    zones = F.array_compact(F.collect_set("country"))
    target = F.array(*[F.lit(z) for z in target_zones or []]).cast("array<string>")
    one = counted.agg(
        F.greatest(F.lit(minimum) - F.coalesce(F.sum("rows"), F.lit(0)), F.lit(0)).alias("short"),
        missing.alias("keywords"),
        (F.when(has(F.col("country").startswith(SUBZONE_PREFIX)), 0).otherwise(1)
         + F.when(has(F.col("country") == SUBZONE_EXPECTED), 0).otherwise(1)).alias("subzones"),
        F.size(F.array_except(zones, target)).alias("unexpected"),
        F.size(F.array_except(target, zones)).alias("missing"),
        *[F.sum(f"null_{c}").alias(f"null_{c}") for c in columns],
    )
    rows = [("min_rows", table, None, "warn", "short"), ("metric_keywords", table, "metric_name", "warn", "keywords"),
            ("subzones", table, "country", "warn", "subzones"), *[("not_null", table, c, "error", f"null_{c}") for c in columns]]
    if target_zones is not None:
        rows += [("zones_unexpected", table, "country", "error", "unexpected"), ("zones_missing", table, "country", "warn", "missing")]
    return _stacked(one, rows)


def unparsable(counts: DataFrame, table: str, severity: str = "warn") -> DataFrame:
    """Cells that hold text but no number, from one row of counts by column (S4); they are NULL in bronze."""
    total = sum((F.col(f"`{c}`") for c in counts.columns), F.lit(0))
    return _stacked(counts.select(total.alias("n")), [("unparsable_cells", table, None, severity, "n")])


def counted(spark: SparkSession, check: str, table: str, failing: int, severity: str = "warn") -> DataFrame:
    """A report row of a count that is known already, such as one that was observed during a write."""
    return spark.createDataFrame([(check, table, None, severity, failing, failing == 0)], REPORT)


class QualityError(ValueError):
    """A check of severity ``error`` has failed."""


def gate(checked: DataFrame) -> DataFrame:
    """Raise if a check of severity ``error`` failed; else return the report. The report has a row for each check."""
    failed = checked.where((F.col("severity") == "error") & ~F.col("passed")).orderBy("check", "table", "column").collect()
    if failed:
        raise QualityError("; ".join(f"{r['check']} {r['table']}.{r['column']}: {r['failing_rows']}" for r in failed))
    return checked


def null_profile(df: DataFrame, table: str) -> DataFrame:
    """One row per table: NULL count of every column."""
    return df.agg(F.lit(table).alias("table"), F.count(F.lit(1)).alias("rows"),
                  *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def report(checks: list[DataFrame]) -> DataFrame:
    out = checks[0].select(*REPORT_COLUMNS)
    for c in checks[1:]:
        out = out.unionByName(c.select(*REPORT_COLUMNS))
    return out
