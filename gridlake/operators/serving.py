"""Serving queries: the dashboard's maths as Spark functions.

Each takes gold tables (DataFrames) and returns a DataFrame; filters are optional so the
same function serves one selection or the whole table. Nothing is collected.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridlake.functions.semantics import BAND_Z
from gridlake.operators.gold import maybe_broadcast, month_hour_baseline

# The dashboard's baseline correction factor.
DASHBOARD_FACTOR = 3.0


def _eq(df: DataFrame, column: str, value) -> DataFrame:
    return df if value is None else df.where(F.col(column) == F.lit(value))


def _in(df: DataFrame, column: str, values) -> DataFrame:
    return df if values is None else df.where(F.col(column).isin(list(values)))


def green_summary(green: DataFrame, country: str | None = None, year: int | None = None) -> DataFrame:
    """Buckets of one zone-year with volatility and residual load both present, by bucket (L1)."""
    rows = _eq(_eq(green, "country_name", country), "year", year)
    return rows.na.drop(how="any", subset=["avg_price_volatility", "avg_residual_load"]).orderBy(
        F.col("country_name").asc_nulls_last(), F.col("year").asc_nulls_last(), F.col("month").asc_nulls_last(),
        F.col("bucket_sort_order").asc_nulls_last(),
    )


def selector_values(green: DataFrame, bronze: DataFrame) -> DataFrame:
    """Selector choices (E12, H3): zones, years (descending), metric names; (selector, value, position)."""
    zones = green.select(F.lit("zone").alias("selector"), F.col("country_name").cast("string").alias("value")).distinct()
    years = green.select(F.lit("year").alias("selector"), F.col("year").cast("string").alias("value")).distinct()
    metrics = bronze.select(F.lit("metric").alias("selector"), F.col("metric_name").alias("value")).distinct()
    both = zones.unionByName(years).unionByName(metrics).where(F.col("value").isNotNull())
    order = Window.partitionBy("selector").orderBy(
        F.when(F.col("selector") == "year", F.col("value")).desc(), F.col("value").asc()
    )
    return both.withColumn("position", F.row_number().over(order))


def risk_kpis(risk: DataFrame, countries=None) -> DataFrame:
    """Total cost, total hours and the average premium (ratio of sums, only with hours > 0)."""
    rows = _in(risk, "country_name", countries)
    agg = rows.agg(
        F.coalesce(F.sum("total_dunkelflaute_cost_eur"), F.lit(0.0)).alias("total_risk_eur"),
        F.coalesce(F.sum("hours_in_dunkelflaute"), F.lit(0)).cast("long").alias("total_hours"),
        F.sum("priced_load_mwh_at_risk").alias("_load"),
    )
    return agg.select(
        "total_risk_eur",
        "total_hours",
        F.when(F.col("total_hours") > 0, F.try_divide(F.col("total_risk_eur"), F.col("_load"))).alias("avg_premium"),
    )


def risk_timeline(risk: DataFrame, countries=None) -> DataFrame:
    """Monthly cost rows with a ``yyyy-mm`` label, in time order (L3)."""
    rows = _in(risk, "country_name", countries)
    return rows.withColumn(
        "date_str", F.concat_ws("-", F.col("year").cast("string"), F.lpad(F.col("month").cast("string"), 2, "0"))
    ).orderBy(F.col("year").asc_nulls_last(), F.col("month").asc_nulls_last(), F.col("country_name").asc_nulls_last())


def duck_curve_month(duck: DataFrame, country: str | None = None, year: int | None = None,
                     month: int | None = None) -> DataFrame:
    """One month's curve by hour (L4)."""
    rows = _eq(_eq(_eq(duck, "country_name", country), "year", year), "month", month)
    return rows.orderBy(F.col("country_name").asc_nulls_last(), F.col("year").asc_nulls_last(),
                        F.col("month").asc_nulls_last(), F.col("hour_of_day").asc_nulls_last())


def duck_shape(duck: DataFrame, country: str | None = None, year: int | None = None,
               month: int | None = None) -> DataFrame:
    """Belly (lowest mean net load, E10) and neck (largest hour-to-hour rise, G5) per curve.

    The window is one curve: at most 24 rows, whatever the data size.
    """
    rows = _eq(_eq(_eq(duck, "country_name", country), "year", year), "month", month)
    curve = Window.partitionBy("country_name", "year", "month").orderBy("hour_of_day")
    steps = rows.withColumn("_rise", F.col("avg_net_load") - F.lag("avg_net_load").over(curve))
    return steps.groupBy("country_name", "year", "month").agg(
        F.min("avg_net_load").alias("min_net_load"),
        F.max("_rise").alias("max_ramp"),
    )


def first_n(df: DataFrame, n: int, *order) -> DataFrame:
    """The first ``n`` rows in a stated order (H4); ties are broken by all other columns, so the rows are certain."""
    keys = [c if not isinstance(c, str) else F.col(c).asc_nulls_last() for c in order]
    return df.orderBy(*keys, *[F.col(c).asc_nulls_last() for c in df.columns]).limit(n)


def historical_band(fact: DataFrame, live: DataFrame, factor: float = DASHBOARD_FACTOR, zone: str = "country_code",
                    band_z: float = BAND_Z, zones: int | None = None) -> DataFrame:
    """Historical price band per (zone, hour) for the live month.

    The (zone, month, hour) baseline is scaled by ``factor``; for each zone the month of its
    earliest live row is the target. Zones whose target month has baseline rows use them;
    the others (no such month, or no live rows) use the mean over months per hour. Quotes are
    reduced to one month a zone, which is broadcast where ``zones`` bounds it; the baseline is
    built once, and both cases are conditional means of one aggregate over it.
    """
    base = month_hour_baseline(fact, factor, zone)
    target = live.where(F.col("country_code").isNotNull()).groupBy("country_code").agg(
        F.month(F.min("event_time")).alias("target")
    )
    matched = base.join(maybe_broadcast(target, zones), "country_code", "left").withColumn(
        "on", F.coalesce(F.col("month") == F.col("target"), F.lit(False)))
    by_hour = matched.groupBy("country_code", "hour").agg(
        F.bool_or("on").alias("has"),
        *[F.avg(F.when(F.col("on"), F.col(c))).alias(f"month_{c}") for c in ("hist_mean", "hist_std")],
        *[F.avg(c).alias(f"all_{c}") for c in ("hist_mean", "hist_std")],
    )
    # a zone whose month has any hour shows that month's hours only
    covered = Window.partitionBy("country_code")
    rows = by_hour.withColumn("covered", F.bool_or("has").over(covered)).where(F.col("has") | ~F.col("covered"))
    pick = lambda c: F.when(F.col("covered"), F.col(f"month_{c}")).otherwise(F.col(f"all_{c}")).alias(c)
    rows = rows.select("country_code", "hour", pick("hist_mean"), pick("hist_std"),
                       F.when(F.col("covered"), "month").otherwise("all_months").alias("basis"))
    return rows.select(
        "country_code", "hour", "hist_mean", "hist_std",
        (F.col("hist_mean") + F.lit(band_z) * F.col("hist_std")).alias("ci_upper"),
        (F.col("hist_mean") - F.lit(band_z) * F.col("hist_std")).alias("ci_lower"),
        "basis",
    ).orderBy("country_code", "hour")


def live_prices(realtime: DataFrame, snapshot: DataFrame | None = None, region: str | None = None) -> DataFrame:
    """Live rows with hour and month (L7); in time order where one region is selected.

    Prices are served as they are, NULL too. Only a frame without a price column falls back: to the expected price,
    or to 0 without that. When the real-time table is empty and a snapshot of price points is given, the snapshot is
    served instead (one ``isEmpty`` probe of the stored table: a single row at most reaches the driver).
    """
    source = realtime
    if snapshot is not None and realtime.isEmpty():
        source = snapshot
    price = next((F.col(c) for c in ("price_eur_mwh", "expected_price") if c in source.columns), F.lit(0.0))
    rows = _eq(source, "region", region).select(
        "event_time",
        "region",
        price.cast("double").alias("price_eur_mwh"),
        F.hour("event_time").alias("hour"),
        F.month("event_time").alias("month"),
    )
    # all regions together have no use for one order, and sorting them would meet in few tasks
    return rows if region is None else rows.orderBy(F.col("hour").asc_nulls_last(), F.col("event_time").asc_nulls_last())
