"""Gold layer: staging views, dimensions, facts and the four analytic marts.

Join strategy: the zone seed and the hour spine are dimensions whose row counts are known on
the driver before anything runs (seed rows; hours between the spine bounds), so they are
broadcast when below ``BROADCAST_BYTES`` and joined normally otherwise. Aggregates that are
joined back (monthly baseline, price profile, month-hour baseline) have a bound of their own,
zones times cells; where the caller names it, they are broadcast too, so that hours are not
shuffled on a few hundred keys. Without a named bound the planner decides.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.functions.semantics import (
    ANOMALY_SIGMAS,
    anomaly_status,
    day_name,
    dow,
    is_peak_hour,
    is_weekend,
    penetration,
    penetration_bucket,
    season,
    surrogate_key,
    z_score,
)
from gridlake.sources import seeds
from gridlake.sources.spine import hour_spine, spine_rows

# Largest side we broadcast by hint, and what a row takes at most in a hash relation, by column.
BROADCAST_BYTES = 64 << 20
COLUMN_BYTES = 24
# Cells of a zone in the price profile (month, weekday, hour) and in the month-hour baseline.
PROFILE_CELLS = 12 * 7 * 24
MONTH_HOUR_CELLS = 12 * 24


def maybe_broadcast(df: DataFrame, rows: int | None, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast only a side whose row count is known and whose bytes are bounded; otherwise let the planner decide."""
    return F.broadcast(df) if rows is not None and rows * COLUMN_BYTES * len(df.columns) <= limit else df


def cell_index(month="month_of_year", weekday="day_of_week", hour="hour_of_day") -> Column:
    """The place of a (month, weekday, hour) among the ``PROFILE_CELLS`` of a zone, from 1; NULL if one is missing."""
    return ((F.col(month) - 1) * 7 + F.col(weekday) - 1) * 24 + F.col(hour) + 1


def dense_cells(baselines: DataFrame, values: list[str]) -> DataFrame:
    """(country_code, cells): one array a zone with the ``values`` of each cell at its place, NULL where it has none.

    Two different rows for one cell end the run: a lookup needs unique keys.
    """
    entries = F.collect_list(F.struct(cell_index().alias("key"), F.struct(*values).alias("value")))
    by_place = baselines.where(cell_index().isNotNull()).groupBy("country_code").agg(F.map_from_entries(entries).alias("by_place"))
    places = F.sequence(F.lit(1), F.lit(PROFILE_CELLS))
    return by_place.select("country_code", F.transform(places, lambda k: F.try_element_at("by_place", k)).alias("cells"))


def with_cells(rows: DataFrame, baselines: DataFrame, values: list[str], zones: int | None, how: str = "inner") -> DataFrame:
    """``rows`` (country_code, month_of_year, day_of_week, hour_of_day, ...) with the ``values`` of their baseline cell.

    With ``zones``, the number of zones, the baselines travel as one dense array a zone, broadcast by that bound, and a
    row finds its cell by index; without it (or beyond the bound) rows and baselines are joined on the four keys.
    """
    keys = ["country_code", "month_of_year", "day_of_week", "hour_of_day"]
    if zones is None or zones * PROFILE_CELLS * COLUMN_BYTES * len(values) > BROADCAST_BYTES:
        return rows.join(baselines.select(*keys, *values), keys, how)
    dense = F.broadcast(dense_cells(baselines.select(*keys, *values), values))
    found = rows.join(dense, "country_code", how).withColumn("_cell", F.try_element_at("cells", cell_index()))
    if how == "inner":
        found = found.where(F.col("_cell").isNotNull())
    return found.select(*rows.columns, *[F.col(f"_cell.{v}").alias(v) for v in values])


# ------------------------------------------------------------------------------ staging
def stg_energy(silver: DataFrame) -> DataFrame:
    """Rename + cast of silver features, with the md5 surrogate key."""
    return silver.select(
        surrogate_key("country", "timestamp").alias("energy_event_id"),
        F.col("timestamp").alias("event_time"),
        F.col("country").alias("country_code"),
        F.col("price").cast("double").alias("price_eur_mwh"),
        F.col("load").cast("double").alias("load_mw"),
        F.col("solar").cast("double").alias("solar_mw"),
        F.col("wind").cast("double").alias("wind_mw"),
        F.col("residual_load").cast("double").alias("residual_load_mw"),
        F.col("volatility_24h").cast("double").alias("volatility_24h"),
        F.col("ramp_rate_pct").cast("double").alias("ramp_rate_pct"),
        F.col("is_extreme_ramp").cast("boolean").alias("is_extreme_ramp"),
        F.col("is_dunkelflaute").cast("boolean").alias("is_dunkelflaute"),
        F.col("year").cast("int").alias("year"),
        F.col("month").cast("int").alias("month"),
        F.col("day").cast("int").alias("day"),
    )


def stg_price_stats(profile: DataFrame) -> DataFrame:
    """Rename + cast of the price profile."""
    return profile.select(
        F.col("country").alias("country_code"),
        F.col("month").cast("int").alias("month_of_year"),
        F.col("weekday").cast("int").alias("day_of_week"),
        F.col("hour").cast("int").alias("hour_of_day"),
        F.col("avg_price_baseline").cast("double").alias("avg_price_baseline"),
        F.col("stddev_price_baseline").cast("double").alias("stddev_price_baseline"),
        F.col("sample_size").cast("int").alias("sample_size"),
    )


# --------------------------------------------------------------------------- dimensions
def dim_country(spark: SparkSession, seed: DataFrame | None = None) -> DataFrame:
    seed = seed if seed is not None else seeds.country_seed(spark)
    return seed.select(F.col("code").alias("country_code"), "country_name", "eu_region")


def dim_energy_metrics(spark: SparkSession, seed: DataFrame | None = None) -> DataFrame:
    seed = seed if seed is not None else seeds.metric_seed(spark)
    return seed.select("metric_code", "metric_name", "category", "is_renewable", "unit")


def date_attributes(spine: DataFrame, ts: str = "time_key") -> DataFrame:
    """Calendar attributes of an hour key (C25); weekday numbering 1 = Sunday … 7 = Saturday."""
    d = dow(ts)
    return spine.select(
        F.col(ts).alias("time_key"),
        F.year(ts).alias("year"),
        F.month(ts).alias("month"),
        F.dayofmonth(ts).alias("day"),
        F.hour(ts).alias("hour_of_day"),
        d.alias("day_of_week_index"),
        day_name(d).alias("day_of_week_name"),
        F.coalesce(is_weekend(d), F.lit(False)).alias("is_weekend"),
        F.coalesce(is_peak_hour(F.hour(ts)), F.lit(False)).alias("is_peak_hour"),
        season(F.month(ts)).alias("season"),
    )


def dim_date(spark: SparkSession, start: dt.datetime, end: dt.datetime) -> DataFrame:
    """Hourly date dimension over ``[start, end)`` (A11 + C25)."""
    return date_attributes(hour_spine(spark, start, end, name="time_key"))


def span_bounds(spark: SparkSession, bronze: DataFrame) -> tuple[dt.datetime, dt.datetime]:
    """Spine bounds from the data (R6): first hour to one hour past the last hour.

    One global min/max aggregate (a single row reaches the driver).
    """
    row = bronze.agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi")).first()
    if row is None or row["lo"] is None:
        now = dt.datetime(1970, 1, 1)
        return now, now
    lo = row["lo"].replace(minute=0, second=0, microsecond=0)
    hi = row["hi"].replace(minute=0, second=0, microsecond=0) + dt.timedelta(hours=1)
    return lo, hi


# -------------------------------------------------------------------------------- facts
def fct_energy_hourly(stg: DataFrame, countries: DataFrame, dates: DataFrame,
                      countries_rows: int | None = seeds.COUNTRY_SEED_ROWS,
                      dates_rows: int | None = None) -> DataFrame:
    """Hourly fact: staging ⋈ zone (left, D1) ⋈ date (left, D2) + penetration.

    ``year``/``month`` come from the date side, so they are NULL outside the spine.
    """
    c = maybe_broadcast(countries.select("country_code", "country_name", "eu_region"), countries_rows)
    d = maybe_broadcast(
        dates.select(
            F.col("time_key"),
            F.col("year").alias("d_year"),
            F.col("month").alias("d_month"),
            F.col("is_weekend"),
            F.col("is_peak_hour"),
        ),
        dates_rows,
    )
    joined = stg.join(c, "country_code", "left").join(d, F.col("event_time") == F.col("time_key"), "left")
    return joined.select(
        "energy_event_id",
        "event_time",
        "country_code",
        "country_name",
        "eu_region",
        F.col("d_year").alias("year"),
        F.col("d_month").alias("month"),
        "is_weekend",
        "is_peak_hour",
        "price_eur_mwh",
        "load_mw",
        "solar_mw",
        "wind_mw",
        (F.col("solar_mw") + F.col("wind_mw")).alias("total_renewable_mw"),
        "residual_load_mw",
        penetration("solar_mw", "wind_mw", "load_mw").alias("renewable_penetration_rate"),
        "volatility_24h",
        "ramp_rate_pct",
        "is_extreme_ramp",
        "is_dunkelflaute",
    )


def fct_price_baselines(stats: DataFrame, countries: DataFrame, k: float = ANOMALY_SIGMAS,
                        countries_rows: int | None = seeds.COUNTRY_SEED_ROWS) -> DataFrame:
    """Price baselines ⋈ zone (left, D3) with the mean ± k·σ band."""
    c = maybe_broadcast(countries.select("country_code", "country_name", "eu_region"), countries_rows)
    return stats.join(c, "country_code", "left").select(
        "country_code",
        "month_of_year",
        "day_of_week",
        "hour_of_day",
        "country_name",
        "eu_region",
        "avg_price_baseline",
        "stddev_price_baseline",
        "sample_size",
        (F.col("avg_price_baseline") + F.lit(k) * F.col("stddev_price_baseline")).alias("upper_bound_price"),
        (F.col("avg_price_baseline") - F.lit(k) * F.col("stddev_price_baseline")).alias("lower_bound_price"),
    )


# -------------------------------------------------------------------------------- marts
def green_performance(fact: DataFrame) -> DataFrame:
    """Hours, volatility, residual load, extreme ramps and price per penetration bucket."""
    bucket = penetration_bucket("renewable_penetration_rate")
    return (
        fact.select(
            "country_name", "year", "month",
            bucket["label"].alias("penetration_bucket"),
            bucket["order"].alias("bucket_sort_order"),
            "price_eur_mwh", "volatility_24h", "residual_load_mw", "is_extreme_ramp",
        )
        .groupBy("country_name", "year", "month", "penetration_bucket", "bucket_sort_order")
        .agg(
            F.count(F.lit(1)).alias("hours_in_bucket"),
            F.avg("volatility_24h").alias("avg_price_volatility"),
            F.avg("residual_load_mw").alias("avg_residual_load"),
            F.count_if(F.col("is_extreme_ramp")).alias("total_extreme_ramps"),
            F.avg("price_eur_mwh").alias("avg_price"),
        )
        .orderBy(F.col("country_name").asc_nulls_last(), F.col("year").asc_nulls_last(),
                 F.col("month").asc_nulls_last(), F.col("bucket_sort_order").asc_nulls_last())
    )


def monthly_price(fact: DataFrame) -> DataFrame:
    """Mean price per (country, year, month) over priced hours."""
    return (
        fact.where(F.col("price_eur_mwh").isNotNull())
        .groupBy("country_code", "year", "month")
        .agg(F.avg("price_eur_mwh").alias("monthly_avg_price"))
    )


def financial_risk(fact: DataFrame, month_rows: int | None = None) -> DataFrame:
    """Dunkelflaute cost against the zone's monthly mean price.

    The monthly baseline is an aggregate joined back (left) on (country, year, month); it has
    ``month_rows`` = zones × months rows at most and is broadcast by that bound. Rows with NULL
    year/month never match it (R6), exactly like the SQL join.
    """
    m = maybe_broadcast(monthly_price(fact), month_rows)
    events = fact.where((F.col("is_dunkelflaute") == F.lit(True)) & F.col("price_eur_mwh").isNotNull())
    joined = events.join(m, ["country_code", "year", "month"], "left")
    risk = joined.groupBy("country_code", "country_name", "year", "month").agg(
        F.count(F.lit(1)).alias("hours_in_dunkelflaute"),
        F.sum("load_mw").alias("priced_load_mwh_at_risk"),
        F.sum((F.col("price_eur_mwh") - F.col("monthly_avg_price")) * F.col("load_mw")).alias(
            "total_dunkelflaute_cost_eur"
        ),
        F.avg("price_eur_mwh").alias("avg_price_during_event"),
        F.max("monthly_avg_price").alias("baseline_monthly_price"),
    )
    return risk.select(
        "country_name",
        "year",
        "month",
        "hours_in_dunkelflaute",
        "priced_load_mwh_at_risk",
        "baseline_monthly_price",
        "avg_price_during_event",
        "total_dunkelflaute_cost_eur",
        (F.col("total_dunkelflaute_cost_eur") / F.nullif(F.col("priced_load_mwh_at_risk"), F.lit(0.0))).alias(
            "risk_premium_per_mwh"
        ),
    ).orderBy(F.col("country_name").asc_nulls_last(), F.col("year").asc_nulls_last(), F.col("month").asc_nulls_last())


def duck_curve(fact: DataFrame) -> DataFrame:
    """Mean load, solar, wind, net load and price per (zone, year, month, hour of day)."""
    return (
        fact.select(
            "country_name", "year", "month", F.hour("event_time").alias("hour_of_day"),
            "load_mw", "solar_mw", "wind_mw", "residual_load_mw", "price_eur_mwh",
        )
        .groupBy("country_name", "year", "month", "hour_of_day")
        .agg(
            F.avg("load_mw").alias("avg_total_load"),
            F.avg("solar_mw").alias("avg_solar_generation"),
            F.avg("wind_mw").alias("avg_wind_generation"),
            F.avg("residual_load_mw").alias("avg_net_load"),
            F.avg("price_eur_mwh").alias("avg_price"),
        )
        .orderBy(F.col("country_name").asc_nulls_last(), F.col("year").asc_nulls_last(),
                 F.col("month").asc_nulls_last(), F.col("hour_of_day").asc_nulls_last())
    )


def price_anomaly(fact: DataFrame, baselines: DataFrame, k: float = ANOMALY_SIGMAS,
                  zones: int | None = None) -> DataFrame:
    """Priced hours with their baseline (inner, D5) on zone, month, weekday, hour; z-score and status.

    ``zones``: how many zones there are, if known; the baselines are then looked up by index (``with_cells``).

    The weekday on both sides is Spark's 1 = Sunday … 7 = Saturday (R1 fixed).
    """
    hourly = fact.where(F.col("price_eur_mwh").isNotNull()).select(
        "energy_event_id",
        "event_time",
        "country_code",
        "price_eur_mwh",
        F.month("event_time").alias("month_of_year"),
        dow("event_time").alias("day_of_week"),
        F.hour("event_time").alias("hour_of_day"),
    )
    return anomaly_columns(with_cells(hourly, baselines, ["avg_price_baseline", "stddev_price_baseline"], zones), k)


def anomaly_columns(joined: DataFrame, k: float = ANOMALY_SIGMAS) -> DataFrame:
    return joined.select(
        "energy_event_id",
        "event_time",
        "country_code",
        F.col("price_eur_mwh").alias("actual_price"),
        F.col("avg_price_baseline").alias("expected_price"),
        "stddev_price_baseline",
        z_score("price_eur_mwh", "avg_price_baseline", "stddev_price_baseline").alias("price_z_score"),
        anomaly_status("price_eur_mwh", "avg_price_baseline", "stddev_price_baseline", k).alias("anomaly_status"),
    )


def month_hour_baseline(fact: DataFrame, factor: float = 1.0, zone: str = "country_code") -> DataFrame:
    """Per (zone, month, hour): mean and sample σ of the price, each times ``factor``.

    ``zone`` may be ``country_code`` or ``country``; NULL zones are dropped.
    """
    return (
        fact.where(F.col(zone).isNotNull())
        .groupBy(F.col(zone).alias("country_code"), F.month("event_time").alias("month"),
                 F.hour("event_time").alias("hour"))
        .agg(
            (F.avg("price_eur_mwh") * F.lit(factor)).alias("hist_mean"),
            (F.stddev_samp("price_eur_mwh") * F.lit(factor)).alias("hist_std"),
        )
    )


def price_anomaly_month_hour(fact: DataFrame, k: float = ANOMALY_SIGMAS, zones: int | None = None) -> DataFrame:
    """Anomaly status against (zone, month, hour) cells, which hold enough samples for 3σ.

    ``zones``: the most that the fact can have, if known; it bounds the baseline.
    """
    base = month_hour_baseline(fact).select(
        "country_code",
        F.col("month").alias("month_of_year"),
        F.col("hour").alias("hour_of_day"),
        F.col("hist_mean").alias("avg_price_baseline"),
        F.col("hist_std").alias("stddev_price_baseline"),
    )
    hourly = fact.where(F.col("price_eur_mwh").isNotNull()).select(
        "energy_event_id", "event_time", "country_code", "price_eur_mwh",
        F.month("event_time").alias("month_of_year"), F.hour("event_time").alias("hour_of_day"),
    )
    base = maybe_broadcast(base, None if zones is None else zones * MONTH_HOUR_CELLS)
    return anomaly_columns(hourly.join(base, ["country_code", "month_of_year", "hour_of_day"], "inner"), k)
