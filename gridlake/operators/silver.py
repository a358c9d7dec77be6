"""Bronze long -> silver wide features and the price profile."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridlake.functions.semantics import DUNKELFLAUTE_SHARE, EXTREME_RAMP, dow, safe_div

# Metric groups, matched in this order by substring of the metric name.
METRIC_GROUPS = [("price_day_ahead", "price"), ("load", "load"), ("solar", "solar"), ("wind", "wind")]
PIVOT_VALUES = sorted(group for _, group in METRIC_GROUPS)   # load, price, solar, wind


def metric_group(metric_name, metric_map: dict[str, str] | None = None):
    """Keyword match (documented contract), or an exact name -> group map when given (R2)."""
    name = F.col(metric_name) if isinstance(metric_name, str) else metric_name
    if metric_map:
        expr = None
        for exact, group in metric_map.items():
            expr = F.when(name == exact, F.lit(group)) if expr is None else expr.when(name == exact, F.lit(group))
        return expr.otherwise(F.lit("other"))
    expr = None
    for keyword, group in METRIC_GROUPS:
        expr = F.when(name.contains(keyword), F.lit(group)) if expr is None else expr.when(name.contains(keyword), F.lit(group))
    return expr.otherwise(F.lit("other"))


def pivot_metrics(bronze: DataFrame, metric_map: dict[str, str] | None = None) -> DataFrame:
    """Long -> one row per (timestamp, country) with mean price, load, solar, wind.

    The pivot values are fixed, so no job runs to discover them and the schema is stable;
    the aggregate is partial on the map side, so a zone with many measurements per hour is
    combined before the shuffle. Missing generation is 0; price and load stay NULL.
    """
    grouped = (
        bronze.select("timestamp", "country", metric_group("metric_name", metric_map).alias("metric_group"), "value")
        .where(F.col("metric_group") != "other")
    )
    # One conditional mean per listed value: a single partial + final aggregation (Spark's
    # ``pivot`` would plan a second aggregation and exchange for the same result).
    wide = grouped.groupBy("timestamp", "country").agg(
        *[F.avg(F.when(F.col("metric_group") == g, F.col("value"))).alias(g) for g in PIVOT_VALUES]
    )
    return wide.na.fill(0.0, subset=["solar", "wind"])


def power_columns(wide: DataFrame) -> DataFrame:
    """renewable_gen = solar + wind; residual_load = load - renewable_gen."""
    return wide.withColumn("renewable_gen", F.col("solar") + F.col("wind")).withColumn(
        "residual_load", F.col("load") - F.col("renewable_gen")
    )


def features(wide: DataFrame, hours: int = 24, ramp: float = EXTREME_RAMP, share: float = DUNKELFLAUTE_SHARE,
             frame: str = "rows") -> DataFrame:
    """Silver feature table (C13–C20, G1–G4): ramp rate, 24-hour volatility, dunkelflaute.

    One window per zone: a zone has one row for each hour, so a task holds as many rows as there are hours in the
    history, whatever the number of measurements. Rows without a zone are a series of their own, rows without a
    timestamp come first in their series; none is dropped.

    ``frame="rows"``: the last ``hours`` rows; a gap stretches the frame (R5). ``frame="range"``: the rows of the last
    ``hours`` hours, whether or not all of them are there. In both, the first ``hours - 1`` rows (or hours) of a zone
    have NULL volatility and NULL dunkelflaute flag.
    """
    base = power_columns(wide).withColumn("renewable_share", safe_div("renewable_gen", "load"))
    w = Window.partitionBy("country").orderBy("timestamp")
    if frame == "rows":
        recent = w.rowsBetween(-(hours - 1), 0)
        valid = F.row_number().over(w) >= hours
    elif frame == "range":
        seconds = F.unix_timestamp(F.col("timestamp").cast("timestamp"))
        by_time = Window.partitionBy("country").orderBy(seconds)
        recent = by_time.rangeBetween(-(hours - 1) * 3600, 0)
        valid = F.coalesce(seconds - F.min(seconds).over(by_time) >= (hours - 1) * 3600, F.lit(False))
    else:
        raise ValueError(f"frame is 'rows' or 'range', not {frame!r}")
    out = base.select(
        "*",
        valid.alias("is_window_valid"),
        F.lag("load", 1).over(w).alias("prev_load"),
        F.stddev_samp("price").over(recent).alias("_vol"),
        F.max("renewable_share").over(recent).alias("max_share_last_24h"),
    ).withColumns({
        "load_diff": F.col("load") - F.col("prev_load"),
        "volatility_24h": F.when(F.col("is_window_valid"), F.col("_vol")),
        "is_dunkelflaute": F.when(F.col("is_window_valid"), F.coalesce(F.col("max_share_last_24h") < F.lit(share), F.lit(False))),
    })
    ramp_rate = F.abs(safe_div("load_diff", "load"))
    out = out.withColumn("ramp_rate_pct", ramp_rate)
    out = out.withColumn("is_extreme_ramp", F.coalesce(F.col("ramp_rate_pct") > F.lit(ramp), F.lit(False)))
    return calendar(out).select(
        "timestamp", "country", "load", "price", "solar", "wind", "renewable_gen", "residual_load",
        "is_window_valid", "prev_load", "load_diff", "ramp_rate_pct", "is_extreme_ramp", "volatility_24h",
        "renewable_share", "max_share_last_24h", "is_dunkelflaute", "year", "month", "day", "weekday", "hour",
    )


def calendar(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """year, month, day, weekday (1 = Sunday … 7 = Saturday), hour."""
    return df.withColumns(
        {
            "year": F.year(ts),
            "month": F.month(ts),
            "day": F.dayofmonth(ts),
            "weekday": dow(ts),
            "hour": F.hour(ts),
        }
    )


def price_profile(silver: DataFrame) -> DataFrame:
    """Price baseline per (country, month, weekday, hour): mean, sample σ, non-NULL count.

    The result has at most zones × 12 × 7 × 24 rows whatever the input size; partial
    aggregation combines each hot cell on the map side.
    """
    return silver.groupBy("country", "month", "weekday", "hour").agg(
        F.avg("price").alias("avg_price_baseline"),
        F.stddev_samp("price").alias("stddev_price_baseline"),
        F.count("price").alias("sample_size"),
    )
