"""Registered queries: one Spark plan and one DuckDB oracle per inventory item.

Every query starts from the driver's tables (through the adapter), so its work grows with
them. Floating results that sums go into are rounded to 10 significant digits on both sides
(after a 12-digit snap): summation order differs between engines in the last bits (see
``oracle``). Values that are only passed on (``exact``) are compared as they are.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlake.operators import bronze as bronze_ops
from gridlake.operators import gold
from gridlake.plans import oracle as O
from gridlake.plans.frames import Frames
from gridlake.sources import driver_tables
from gridlake.streaming import scoring

QueryFn = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, QueryFn] = {}
_SQL: dict[str, str] = {}


def sig(x: Column, digits: int = O.SIG_DIGITS) -> Column:
    """Round to ``digits`` significant digits (same steps as ``oracle.sig``)."""
    k = F.lit(digits - 1) - F.floor(F.log10(F.abs(x)))
    p = F.pow(F.lit(10.0), k)
    q = F.pow(F.lit(10.0), -k)
    return (
        F.when(x.isNull() | (x == 0) | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), x)
        .when(k >= 0, F.round(x * p, 0) / p)
        .otherwise(F.round(x / q, 0) * q)
    )


def rounded(df: DataFrame, exact: frozenset[str] = frozenset()) -> DataFrame:
    """Snap doubles to 12 digits, then round to 10 — two projections, so each stage refers
    to plain columns (one nested expression would repeat the inner stage in the outer)."""
    doubles = {f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)} - exact
    if not doubles:
        return df
    snapped = df.withColumns({c: sig(F.col(c), O.SNAP_DIGITS) for c in doubles})
    return snapped.withColumns({c: sig(F.col(c)) for c in doubles})


def register(name: str, sql: str | None, exact: tuple[str, ...] = ()):
    def deco(fn: Callable[[Frames], DataFrame]):
        _QUERIES[name] = lambda spark, sf_dir: rounded(fn(Frames(spark, sf_dir)), frozenset(exact))
        if sql is not None:
            _SQL[name] = sql
        return fn
    return deco


def queries() -> dict[str, QueryFn]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _sel(cte: str, cols: list[str], doubles: set[str]) -> str:
    items = [O.r(c, c) if c in doubles else c for c in cols]
    return O.with_ctes(cte) + f"SELECT {', '.join(items)} FROM {cte}"


# --------------------------------------------------------------------------- bronze
@register("bronze_long", _sel("bronze", ["timestamp", "country", "metric_name", "value", "year", "month"], set()), exact=("value",))
def _bronze_long(f: Frames) -> DataFrame:
    return f.bronze


WIDE_TO_LONG_SQL = O.with_ctes("bronze") + f"""
SELECT "timestamp", country, metric_name, {O.r('avg(value)', 'value')},
       CAST(year("timestamp") AS VARCHAR) AS year, lpad(CAST(month("timestamp") AS VARCHAR), 2, '0') AS month
FROM bronze GROUP BY "timestamp", country, metric_name"""


@register("wide_to_long", WIDE_TO_LONG_SQL)
def _wide_to_long(f: Frames) -> DataFrame:
    return bronze_ops.to_long(driver_tables.wide_from_events(f.events))


# --------------------------------------------------------------------------- silver
@register("metric_pivot", O.with_ctes("wide") + f"""
SELECT "timestamp", country, {O.r('load', 'load')}, {O.r('price', 'price')}, {O.r('solar', 'solar')},
       {O.r('wind', 'wind')}, {O.r('solar + wind', 'renewable_gen')}, {O.r('load - (solar + wind)', 'residual_load')}
FROM wide""")
def _metric_pivot(f: Frames) -> DataFrame:
    from gridlake.operators import silver
    return silver.power_columns(f.wide)


SILVER_DOUBLES = {"load", "price", "solar", "wind", "renewable_gen", "residual_load", "prev_load", "load_diff",
                  "ramp_rate_pct", "volatility_24h", "renewable_share", "max_share_last_24h"}
SILVER_COLS = ["timestamp", "country", "load", "price", "solar", "wind", "renewable_gen", "residual_load",
               "is_window_valid", "prev_load", "load_diff", "ramp_rate_pct", "is_extreme_ramp", "volatility_24h",
               "renewable_share", "max_share_last_24h", "is_dunkelflaute", "year", "month", "day", "weekday", "hour"]
RAMP_COLS = ["timestamp", "country", "load", "prev_load", "load_diff", "ramp_rate_pct", "is_extreme_ramp"]
VOL_COLS = ["timestamp", "country", "price", "is_window_valid", "volatility_24h"]
DUNKEL_COLS = ["timestamp", "country", "renewable_gen", "load", "renewable_share", "max_share_last_24h",
               "is_dunkelflaute"]


@register("silver_features", _sel("silver", SILVER_COLS, SILVER_DOUBLES))
def _silver_features(f: Frames) -> DataFrame:
    return f.silver


@register("ramp_features", _sel("silver", RAMP_COLS, SILVER_DOUBLES))
def _ramp(f: Frames) -> DataFrame:
    return f.silver.select(*RAMP_COLS)


@register("volatility_24h", _sel("silver", VOL_COLS, SILVER_DOUBLES))
def _vol(f: Frames) -> DataFrame:
    return f.silver.select(*VOL_COLS)


@register("dunkelflaute", _sel("silver", DUNKEL_COLS, SILVER_DOUBLES))
def _dunkel(f: Frames) -> DataFrame:
    return f.silver.select(*DUNKEL_COLS)


@register("price_profile", _sel("profile", ["country", "month", "weekday", "hour", "avg_price_baseline",
                                            "stddev_price_baseline", "sample_size"],
                                {"avg_price_baseline", "stddev_price_baseline"}))
def _profile(f: Frames) -> DataFrame:
    return f.profile


@register("price_profile_incremental", _sel("profile", ["country", "month", "weekday", "hour", "avg_price_baseline",
                                                        "stddev_price_baseline", "sample_size"],
                                            {"avg_price_baseline", "stddev_price_baseline"}))
def _profile_incremental(f: Frames) -> DataFrame:
    """The profile merged from the moments of single days."""
    from gridlake.operators import baselines
    return baselines.profile(baselines.moments(f.silver, by_day=True))


@register("month_hour_incremental", _sel("mh_base", ["country_code", "month", "hour", "hist_mean", "hist_std"], {"hist_mean", "hist_std"}))
def _month_hour_incremental(f: Frames) -> DataFrame:
    """The month-hour baseline merged from the moments of single days and weekdays."""
    from gridlake.operators import baselines
    return baselines.month_hour(baselines.moments(f.silver, by_day=True))


# ----------------------------------------------------------------------------- gold
STG_COLS = ["energy_event_id", "event_time", "country_code", "price_eur_mwh", "load_mw", "solar_mw", "wind_mw",
            "residual_load_mw", "volatility_24h", "ramp_rate_pct", "is_extreme_ramp", "is_dunkelflaute", "year",
            "month", "day"]
STG_DOUBLES = {"price_eur_mwh", "load_mw", "solar_mw", "wind_mw", "residual_load_mw", "volatility_24h",
               "ramp_rate_pct"}


@register("stg_energy", _sel("stg_energy", STG_COLS, STG_DOUBLES))
def _stg_energy(f: Frames) -> DataFrame:
    return f.stg_energy


@register("stg_price_stats", _sel("stg_price_stats", ["country_code", "month_of_year", "day_of_week", "hour_of_day",
                                                      "avg_price_baseline", "stddev_price_baseline", "sample_size"],
                                  {"avg_price_baseline", "stddev_price_baseline"}))
def _stg_stats(f: Frames) -> DataFrame:
    return f.stg_price_stats


@register("dim_date", _sel("dim_date", ["time_key", "year", "month", "day", "hour_of_day", "day_of_week_index",
                                        "day_of_week_name", "is_weekend", "is_peak_hour", "season"], set()))
def _dim_date(f: Frames) -> DataFrame:
    return f.dim_date


FCT_COLS = ["energy_event_id", "event_time", "country_code", "country_name", "eu_region", "year", "month",
            "is_weekend", "is_peak_hour", "price_eur_mwh", "load_mw", "solar_mw", "wind_mw", "total_renewable_mw",
            "residual_load_mw", "renewable_penetration_rate", "volatility_24h", "ramp_rate_pct", "is_extreme_ramp",
            "is_dunkelflaute"]
FCT_DOUBLES = STG_DOUBLES | {"total_renewable_mw", "renewable_penetration_rate"}


@register("fct_energy_hourly", _sel("fct", FCT_COLS, FCT_DOUBLES))
def _fct(f: Frames) -> DataFrame:
    return f.fct_energy_hourly


BASE_COLS = ["country_code", "month_of_year", "day_of_week", "hour_of_day", "country_name", "eu_region",
             "avg_price_baseline", "stddev_price_baseline", "sample_size", "upper_bound_price", "lower_bound_price"]


@register("fct_price_baselines", _sel("baselines", BASE_COLS, {"avg_price_baseline", "stddev_price_baseline",
                                                                "upper_bound_price", "lower_bound_price"}))
def _fct_base(f: Frames) -> DataFrame:
    return f.fct_price_baselines


GREEN_COLS = ["country_name", "year", "month", "penetration_bucket", "bucket_sort_order", "hours_in_bucket",
              "avg_price_volatility", "avg_residual_load", "total_extreme_ramps", "avg_price"]


@register("green_performance", _sel("green", GREEN_COLS, {"avg_price_volatility", "avg_residual_load", "avg_price"}))
def _green(f: Frames) -> DataFrame:
    return gold.green_performance(f.fct_energy_hourly)


RISK_COLS = ["country_name", "year", "month", "hours_in_dunkelflaute", "priced_load_mwh_at_risk",
             "baseline_monthly_price", "avg_price_during_event", "total_dunkelflaute_cost_eur", "risk_premium_per_mwh"]
RISK_DOUBLES = {"priced_load_mwh_at_risk", "baseline_monthly_price", "avg_price_during_event",
                "total_dunkelflaute_cost_eur", "risk_premium_per_mwh"}


@register("financial_risk", _sel("risk", RISK_COLS, RISK_DOUBLES))
def _risk(f: Frames) -> DataFrame:
    return _risk_mart(f)


def _risk_mart(f: Frames) -> DataFrame:
    return gold.financial_risk(f.fct_energy_hourly, f.month_rows)


DUCK_COLS = ["country_name", "year", "month", "hour_of_day", "avg_total_load", "avg_solar_generation",
             "avg_wind_generation", "avg_net_load", "avg_price"]


@register("duck_curve", _sel("duck", DUCK_COLS, set(DUCK_COLS[4:])))
def _duck(f: Frames) -> DataFrame:
    return gold.duck_curve(f.fct_energy_hourly)


ANOM_COLS = ["energy_event_id", "event_time", "country_code", "actual_price", "expected_price",
             "stddev_price_baseline", "price_z_score", "anomaly_status"]
ANOM_DOUBLES = {"actual_price", "expected_price", "stddev_price_baseline", "price_z_score"}


@register("price_anomaly", _sel("anomaly", ANOM_COLS, ANOM_DOUBLES))
def _anomaly(f: Frames) -> DataFrame:
    return gold.price_anomaly(f.fct_energy_hourly, f.fct_price_baselines, zones=f.zones)


@register("price_anomaly_one_sigma", O.with_ctes("anomaly") + ", one AS (" + O.anomaly_cte(1.0) + ")\n"
          + f"SELECT {', '.join(O.r(c, c) if c in ANOM_DOUBLES else c for c in ANOM_COLS)} FROM one")
def _anomaly_one(f: Frames) -> DataFrame:
    return gold.price_anomaly(f.fct_energy_hourly, f.fct_price_baselines, k=1.0, zones=f.zones)


@register("price_anomaly_month_hour", _sel("anomaly_mh", ANOM_COLS, ANOM_DOUBLES))
def _anomaly_mh(f: Frames) -> DataFrame:
    return gold.price_anomaly_month_hour(f.fct_energy_hourly, zones=f.zones)


# ------------------------------------------------------------------------ streaming
LIVE_SQL = O.with_ctes("live") + f"""
SELECT event_time, region, price_eur_mwh, {O.r('expected_price', 'expected_price')},
       {O.r('z_score', 'z_score')},
       CASE WHEN z_score > 3 THEN 'CRITICAL' WHEN z_score > 2 THEN 'WARNING'
            WHEN z_score < -2 THEN 'OPPORTUNITY' ELSE 'NORMAL' END AS anomaly_level
FROM live"""


def live_messages(f: Frames) -> DataFrame:
    """Price events as published messages: a carrier frame with one JSON ``value`` column."""
    q = driver_tables.price_quotes(f.events)
    return q.select(F.to_json(F.struct("timestamp_ms", "price_eur_mwh", "unit", "region", "ingested_at")).alias("value"))


def _scored(f: Frames) -> DataFrame:
    good, _ = scoring.split_bad(scoring.decode(live_messages(f)))
    return scoring.score(good, f.fct_price_baselines, zones=f.zones)


@register("live_scores", LIVE_SQL, exact=("price_eur_mwh",))
def _live(f: Frames) -> DataFrame:
    return _scored(f)


# ------------------------------------------------------------------- feed payloads
PAYLOAD_COLS = ["event_id", "region", "start_timestamp", "end_timestamp", "marketprice", "unit", "event_time",
                "price_eur_mwh", "hour", "month"]


def _points(f: Frames) -> DataFrame:
    from gridlake.sources import payload
    return payload.price_points(payload.parse_payload(driver_tables.payload_documents(f.events)))


@register("payload_explode", O.with_ctes("docs") + f"""
SELECT event_id, region, start_timestamp, end_timestamp, marketprice, unit,
       make_timestamp(start_timestamp * 1000) AS event_time, marketprice AS price_eur_mwh,
       CAST(hour(make_timestamp(start_timestamp * 1000)) AS INTEGER) AS hour,
       CAST(month(make_timestamp(start_timestamp * 1000)) AS INTEGER) AS month
FROM docs""", exact=("marketprice", "price_eur_mwh"))
def _payload(f: Frames) -> DataFrame:
    return _points(f)


@register("payload_lists", O.with_ctes("docs") + """
SELECT region, count(*) AS n_points, start_timestamp, end_timestamp, marketprice, unit,
       CAST(make_timestamp(start_timestamp * 1000) AS DATE) AS day
FROM docs WHERE region IS NOT NULL GROUP BY ALL""", exact=("marketprice",))
def _payload_lists(f: Frames) -> DataFrame:
    from gridlake.sources import payload
    points = payload.price_points(payload.parse_payload(driver_tables.payload_lists(f.events)))
    keys = ["region", "start_timestamp", "end_timestamp", "marketprice", "unit"]
    return points.groupBy(*keys, F.to_date("event_time").alias("day")).agg(F.count(F.lit(1)).alias("n_points"))


# the time of arrival as whole microseconds, so that no fraction of a second escapes the comparison
@register("publish_json", O.with_ctes("quotes") + """
SELECT timestamp_ms, price_eur_mwh, unit, region, CAST(round(ingested_at * 1e6) AS BIGINT) AS ingested_at_us
FROM quotes""", exact=("price_eur_mwh",))
def _publish(f: Frames) -> DataFrame:
    from gridlake import schemas
    from gridlake.sinks import writers
    q = driver_tables.price_quotes(f.events).select(
        F.col("timestamp_ms").alias("start_timestamp"), F.col("price_eur_mwh").alias("marketprice"), "unit",
        "region", "ingested_at")
    msgs = writers.publish_messages(q, ingested_at=F.col("ingested_at"))
    full = schemas.STREAM_MESSAGE.add("unit", "string")
    return msgs.select(F.from_json("value", full).alias("m")).select(
        "m.timestamp_ms", "m.price_eur_mwh", "m.unit", "m.region",
        F.round(F.col("m.ingested_at") * 1e6).cast("long").alias("ingested_at_us"))


SNAPSHOT_TIME = "2024-02-01 00:00:00"


@register("snapshot_rows", O.with_ctes("docs") + f"""
SELECT start_timestamp, end_timestamp, marketprice, unit, region,
       strftime(TIMESTAMP '{SNAPSHOT_TIME}', '%Y-%m-%dT%H:%M:%S.%f') AS ingestion_time,
       strftime(TIMESTAMP '{SNAPSHOT_TIME}', '%Y%m%d') AS snapshot_date
FROM docs""", exact=("marketprice",))
def _snapshot(f: Frames) -> DataFrame:
    from gridlake.sinks import writers
    return writers.snapshot_rows(_points(f), ingestion_time=SNAPSHOT_TIME)


# -------------------------------------------------------------------- data quality
def _dq(check, table, column, severity, failing_sql):
    col = "NULL" if column is None else f"'{column}'"
    return (f"SELECT '{check}' AS \"check\", '{table}' AS \"table\", CAST({col} AS VARCHAR) AS \"column\", "
            f"'{severity}' AS severity, CAST(coalesce(({failing_sql}), 0) AS BIGINT) AS failing_rows, "
            f"coalesce(({failing_sql}), 0) = 0 AS passed")


def _uniq(t, c):
    return f"SELECT count(*) FROM (SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)"


def _nn(t, c):
    return f"SELECT count(*) FROM {t} WHERE {c} IS NULL"


DQ_PARTS = [
    _dq("unique", "dim_country", "country_code", "error", _uniq("dim_country", "country_code")),
    _dq("unique", "dim_date", "time_key", "error", _uniq("dim_date", "time_key")),
    _dq("unique", "dim_energy_metrics", "metric_code", "error", _uniq("dim_metrics", "metric_code")),
    _dq("unique", "fct_energy_hourly", "energy_event_id", "error", _uniq("fct", "energy_event_id")),
    _dq("unique", "stg_energy", "energy_event_id", "error", _uniq("stg_energy", "energy_event_id")),
    _dq("not_null", "dim_country", "country_code", "error", _nn("dim_country", "country_code")),
    _dq("not_null", "dim_date", "time_key", "error", _nn("dim_date", "time_key")),
    _dq("not_null", "dim_energy_metrics", "metric_code", "error", _nn("dim_metrics", "metric_code")),
    _dq("not_null", "fct_energy_hourly", "energy_event_id", "error", _nn("fct", "energy_event_id")),
    _dq("not_null", "stg_energy", "energy_event_id", "error", _nn("stg_energy", "energy_event_id")),
    _dq("not_null", "fct_price_baselines", "country_code", "error", _nn("baselines", "country_code")),
    _dq("not_null", "fct_price_baselines", "avg_price_baseline", "error", _nn("baselines", "avg_price_baseline")),
    _dq("not_null", "stg_price_stats", "country_code", "error", _nn("stg_price_stats", "country_code")),
    _dq("not_null", "mrt_price_anomaly_detection", "price_z_score", "warn", _nn("anomaly", "price_z_score")),
    _dq("not_null", "stg_energy", "price_eur_mwh", "warn", _nn("stg_energy", "price_eur_mwh")),
    _dq("relationships", "fct_energy_hourly", "country_code", "error",
        "SELECT count(*) FROM fct f WHERE f.country_code IS NOT NULL AND NOT EXISTS "
        "(SELECT 1 FROM dim_country c WHERE c.country_code = f.country_code)"),
    _dq("columns_present", "bronze", None, "error",
        "SELECT count(*) FROM (VALUES ('timestamp'), ('country'), ('metric_name'), ('value'), ('year'), ('month')) n(c) "
        "WHERE c NOT IN (SELECT unnest(json_keys(to_json(b))) FROM (SELECT * FROM bronze LIMIT 1) b) "
        "AND EXISTS (SELECT 1 FROM bronze)"),
    _dq("min_rows", "bronze", None, "warn", "SELECT greatest(1000000 - count(*), 0) FROM bronze"),
    _dq("zones_unexpected", "bronze", "country", "error",
        "SELECT count(*) FROM (SELECT DISTINCT country AS zone FROM bronze WHERE country IS NOT NULL) a "
        "WHERE NOT EXISTS (SELECT 1 FROM header_zones t WHERE t.zone = a.zone)"),
    _dq("zones_missing", "bronze", "country", "warn",
        "SELECT count(*) FROM header_zones t WHERE NOT EXISTS (SELECT 1 FROM bronze a WHERE a.country = t.zone)"),
    _dq("metric_keywords", "bronze", "metric_name", "warn",
        "SELECT (CASE WHEN coalesce(bool_or(contains(metric_name, 'price')), false) THEN 0 ELSE 1 END) + "
        "(CASE WHEN coalesce(bool_or(contains(metric_name, 'load')), false) THEN 0 ELSE 1 END) + "
        "(CASE WHEN coalesce(bool_or(contains(metric_name, 'generation')), false) THEN 0 ELSE 1 END) FROM bronze"),
    _dq("not_null", "bronze", "country", "error", _nn("bronze", "country")),
    _dq("not_null", "bronze", "timestamp", "error", _nn("bronze", '"timestamp"')),
    _dq("not_null", "bronze", "value", "error", _nn("bronze", "value")),
    _dq("subzones", "bronze", "country", "warn",
        "SELECT (CASE WHEN count(*) FILTER (WHERE starts_with(country, 'SE_')) = 0 THEN 1 ELSE 0 END) + "
        "(CASE WHEN count(*) FILTER (WHERE country = 'SE_1') = 0 THEN 1 ELSE 0 END) FROM bronze"),
]
DQ_SQL = O.with_ctes("dim_country", "dim_date", "dim_metrics", "fct", "stg_energy", "baselines", "stg_price_stats",
                     "anomaly", "bronze", "header_zones") + "\nUNION ALL\n".join(DQ_PARTS)


@register("dq_report", DQ_SQL)
def _dq_report(f: Frames) -> DataFrame:
    from gridlake.operators import gold as g
    from gridlake.operators import quality as dq
    from gridlake.sources import seeds
    from gridlake.sources.wide_csv import discover_zones
    spark = f.spark
    metrics = g.dim_energy_metrics(spark)
    anomaly = g.price_anomaly(f.fct_energy_hourly, f.fct_price_baselines, zones=f.zones)
    checks = [
        dq.key(f.dim_country, "dim_country", "country_code"),
        dq.key(f.dim_date, "dim_date", "time_key"),
        dq.key(metrics, "dim_energy_metrics", "metric_code"),
        dq.key(f.fct_energy_hourly, "fct_energy_hourly", "energy_event_id"),
        dq.key(f.stg_energy, "stg_energy", "energy_event_id", {"price_eur_mwh": "warn"}),
        dq.not_null(f.fct_price_baselines, "fct_price_baselines", ["country_code", "avg_price_baseline"]),
        dq.not_null(f.stg_price_stats, "stg_price_stats", ["country_code"]),
        dq.not_null(anomaly, "mrt_price_anomaly_detection", ["price_z_score"], severity="warn"),
        dq.relationship(f.fct_energy_hourly, "fct_energy_hourly", "country_code", f.dim_country, "country_code",
                        parent_rows=seeds.COUNTRY_SEED_ROWS),
        dq.columns_present(spark, f.bronze, "bronze"),
        dq.bronze_checks(f.bronze, "bronze", discover_zones(driver_tables.wide_columns())),
    ]
    return dq.report(checks)


@register("hours_by_part", O.with_ctes("fct") + """
SELECT country_code, year, count(*) FILTER (WHERE event_time IS NOT NULL AND country_code IS NOT NULL) AS rows,
       count(DISTINCT date_trunc('hour', event_time)) FILTER (WHERE country_code IS NOT NULL) AS hours,
       count(*) FILTER (WHERE event_time <> date_trunc('hour', event_time) AND country_code IS NOT NULL) AS off_hour,
       count(*) FILTER (WHERE event_time IS NULL OR country_code IS NULL) AS without
FROM fct GROUP BY country_code, year""")
def _hours_by_part(f: Frames) -> DataFrame:
    """Rows and hours of each zone and year: equal where the key of the hourly fact is unique."""
    from gridlake.operators import quality as dq
    return dq.hours_by_part(f.fct_energy_hourly, "country_code", "event_time", ["year"])


@register("zone_set_diff", O.with_ctes("bronze", "dim_country") + """
SELECT zone, 'unexpected' AS status FROM (SELECT DISTINCT country AS zone FROM bronze WHERE country IS NOT NULL) a
WHERE NOT EXISTS (SELECT 1 FROM dim_country c WHERE c.country_code = a.zone)
UNION ALL
SELECT country_code AS zone, 'missing' AS status FROM dim_country c
WHERE NOT EXISTS (SELECT 1 FROM bronze a WHERE a.country = c.country_code)""")
def _zone_diff(f: Frames) -> DataFrame:
    from gridlake.operators import quality as dq
    return dq.zone_set_diff(f.bronze, f.dim_country.select(F.col("country_code").alias("country")))


@register("orphan_zones", O.with_ctes("fct", "dim_country") + """
SELECT f.country_code, count(*) AS rows FROM fct f
WHERE f.country_code IS NOT NULL AND f.country_code NOT IN (SELECT country_code FROM dim_country WHERE eu_region = 'Northern Europe')
GROUP BY f.country_code""")
def _orphans(f: Frames) -> DataFrame:
    from gridlake.operators import quality as dq
    return dq.orphans(f.fct_energy_hourly, "country_code", f.dim_country.where("eu_region = 'Northern Europe'"), "country_code")


@register("null_profile_features", O.with_ctes("silver") + "SELECT 'silver' AS \"table\", count(*) AS rows, "
          + ", ".join(f'count(*) FILTER (WHERE "{c}" IS NULL) AS "{c}"' for c in SILVER_COLS) + " FROM silver")
def _null_features(f: Frames) -> DataFrame:
    from gridlake.operators import quality as dq
    return dq.null_profile(f.silver, "silver")


@register("null_profile", O.with_ctes("bronze") + """
SELECT 'bronze' AS "table", count(*) AS rows,
       count(*) FILTER (WHERE "timestamp" IS NULL) AS "timestamp", count(*) FILTER (WHERE country IS NULL) AS country,
       count(*) FILTER (WHERE metric_name IS NULL) AS metric_name, count(*) FILTER (WHERE value IS NULL) AS value,
       count(*) FILTER (WHERE year IS NULL) AS year, count(*) FILTER (WHERE month IS NULL) AS month
FROM bronze""")
def _null_profile(f: Frames) -> DataFrame:
    from gridlake.operators import quality as dq
    return dq.null_profile(f.bronze, "bronze")


# ------------------------------------------------------------------------- serving
@register("green_summary", _sel("green", GREEN_COLS, {"avg_price_volatility", "avg_residual_load", "avg_price"})
          + " WHERE avg_price_volatility IS NOT NULL AND avg_residual_load IS NOT NULL")
def _green_summary(f: Frames) -> DataFrame:
    from gridlake.operators import serving
    return serving.green_summary(gold.green_performance(f.fct_energy_hourly))


@register("selector_values", O.with_ctes("green", "bronze") + """
SELECT selector, value, row_number() OVER (PARTITION BY selector
         ORDER BY CASE WHEN selector = 'year' THEN value END DESC NULLS LAST, value ASC) AS position
FROM (SELECT DISTINCT 'zone' AS selector, CAST(country_name AS VARCHAR) AS value FROM green
      UNION SELECT DISTINCT 'year', CAST(year AS VARCHAR) FROM green
      UNION SELECT DISTINCT 'metric', metric_name FROM bronze) s
WHERE value IS NOT NULL""")
def _selectors(f: Frames) -> DataFrame:
    from gridlake.operators import serving
    return serving.selector_values(gold.green_performance(f.fct_energy_hourly), f.bronze)


@register("risk_kpis", O.with_ctes("risk") + f"""
SELECT {O.r('coalesce(sum(total_dunkelflaute_cost_eur), 0.0)', 'total_risk_eur')},
       CAST(coalesce(sum(hours_in_dunkelflaute), 0) AS BIGINT) AS total_hours,
       {O.r('CASE WHEN coalesce(sum(hours_in_dunkelflaute), 0) > 0 THEN coalesce(sum(total_dunkelflaute_cost_eur), 0.0) / NULLIF(sum(priced_load_mwh_at_risk), 0) END', 'avg_premium')}
FROM risk""")
def _risk_kpis(f: Frames) -> DataFrame:
    from gridlake.operators import serving
    return serving.risk_kpis(_risk_mart(f))


@register("risk_timeline", O.with_ctes("risk") + f"""
SELECT {', '.join(O.r(c, c) if c in RISK_DOUBLES else c for c in RISK_COLS)},
       concat_ws('-', CAST(year AS VARCHAR), lpad(CAST(month AS VARCHAR), 2, '0')) AS date_str
FROM risk""")
def _risk_timeline(f: Frames) -> DataFrame:
    from gridlake.operators import serving
    return serving.risk_timeline(_risk_mart(f))


# selections of one user of the dashboard: a zone and year, two zones, one month
ZONE_NAME, TWO_ZONES, YEAR, MONTH = "Austria", ("Austria", "Sweden (Luleå)"), 2024, 1


@register("duck_curve_month", _sel("duck", DUCK_COLS, set(DUCK_COLS[4:]))
          + f" WHERE country_name = '{ZONE_NAME}' AND year = {YEAR} AND month = {MONTH}")
def _duck_month(f: Frames) -> DataFrame:
    from gridlake.operators import serving
    return serving.duck_curve_month(gold.duck_curve(f.fct_energy_hourly), ZONE_NAME, YEAR, MONTH)


@register("green_summary_zone_year", _sel("green", GREEN_COLS, {"avg_price_volatility", "avg_residual_load", "avg_price"})
          + " WHERE avg_price_volatility IS NOT NULL AND avg_residual_load IS NOT NULL"
          + f" AND country_name = '{ZONE_NAME}' AND year = {YEAR}")
def _green_zone_year(f: Frames) -> DataFrame:
    from gridlake.operators import serving
    return serving.green_summary(gold.green_performance(f.fct_energy_hourly), ZONE_NAME, YEAR)


@register("risk_kpis_two_zones", O.with_ctes("risk") + f"""
SELECT {O.r('coalesce(sum(total_dunkelflaute_cost_eur), 0.0)', 'total_risk_eur')},
       CAST(coalesce(sum(hours_in_dunkelflaute), 0) AS BIGINT) AS total_hours,
       {O.r('CASE WHEN coalesce(sum(hours_in_dunkelflaute), 0) > 0 THEN coalesce(sum(total_dunkelflaute_cost_eur), 0.0) / NULLIF(sum(priced_load_mwh_at_risk), 0) END', 'avg_premium')}
FROM risk WHERE country_name IN {TWO_ZONES}""")
def _risk_two(f: Frames) -> DataFrame:
    from gridlake.operators import serving
    return serving.risk_kpis(_risk_mart(f), TWO_ZONES)


@register("first_buckets", O.with_ctes("green") + """
SELECT country_name, year, month, penetration_bucket, bucket_sort_order, hours_in_bucket FROM green
ORDER BY hours_in_bucket DESC, country_name, year, month, penetration_bucket, bucket_sort_order LIMIT 10""")
def _first_buckets(f: Frames) -> DataFrame:
    from gridlake.operators import serving
    green = gold.green_performance(f.fct_energy_hourly).select(*GREEN_COLS[:6])
    return serving.first_n(green, 10, F.col("hours_in_bucket").desc())


@register("duck_shape", O.with_ctes("duck") + f"""
SELECT country_name, year, month, {O.r('min(avg_net_load)', 'min_net_load')}, {O.r('max(rise)', 'max_ramp')}
FROM (SELECT *, avg_net_load - lag(avg_net_load) OVER (PARTITION BY country_name, year, month
                                                         ORDER BY hour_of_day) AS rise FROM duck) d
GROUP BY country_name, year, month""")
def _duck_shape(f: Frames) -> DataFrame:
    from gridlake.operators import serving
    return serving.duck_shape(gold.duck_curve(f.fct_energy_hourly))


def _live_points(f: Frames) -> DataFrame:
    from gridlake.functions.semantics import region_to_zone
    good, _ = scoring.split_bad(scoring.decode(live_messages(f)))
    return good.select(F.timestamp_millis("timestamp_ms").alias("event_time"),
                       region_to_zone("region").alias("country_code"))


def _band_sql(quotes: str) -> str:
    return O.with_ctes("fct", "quotes") + f"""
, base AS (
  SELECT country_code, month(event_time) AS month, hour(event_time) AS hour,
         avg(price_eur_mwh) * 3.0 AS hist_mean, stddev_samp(price_eur_mwh) * 3.0 AS hist_std
  FROM fct WHERE country_code IS NOT NULL GROUP BY 1, 2, 3),
target AS (
  SELECT CASE WHEN region = 'DE' THEN 'DE_LU' WHEN region = 'AT' THEN 'AT' ELSE region END AS country_code,
         month(min(make_timestamp(timestamp_ms * 1000))) AS month
  FROM quotes WHERE timestamp_ms IS NOT NULL AND {quotes} GROUP BY 1),
month_rows AS (
  SELECT b.country_code, b.hour, b.hist_mean, b.hist_std, 'month' AS basis
  FROM base b JOIN target t ON b.country_code = t.country_code AND b.month = t.month),
fallback AS (
  SELECT country_code, hour, avg(hist_mean) AS hist_mean, avg(hist_std) AS hist_std, 'all_months' AS basis
  FROM base GROUP BY 1, 2),
band AS (
  SELECT * FROM month_rows
  UNION ALL
  SELECT * FROM fallback f WHERE NOT EXISTS (SELECT 1 FROM month_rows m WHERE m.country_code = f.country_code))
SELECT country_code, CAST(hour AS INTEGER) AS hour, {O.r('hist_mean', 'hist_mean')}, {O.r('hist_std', 'hist_std')},
       {O.r('hist_mean + 1.96 * hist_std', 'ci_upper')}, {O.r('hist_mean - 1.96 * hist_std', 'ci_lower')}, basis
FROM band"""


@register("historical_band", _band_sql("true"))
def _band(f: Frames) -> DataFrame:
    from gridlake.operators import serving
    return serving.historical_band(f.fct_energy_hourly, _live_points(f), zones=f.zones)


# live quotes of one region alone: the other zones fall back to all months
@register("historical_band_all_months", _band_sql("region = 'DE'"))
def _band_all(f: Frames) -> DataFrame:
    from gridlake.operators import serving
    live = _live_points(f).where("country_code = 'DE_LU'")
    return serving.historical_band(f.fct_energy_hourly, live, zones=f.zones)


@register("live_prices", O.with_ctes("quotes") + """
SELECT make_timestamp(timestamp_ms * 1000) AS event_time, region, price_eur_mwh,
       CAST(hour(make_timestamp(timestamp_ms * 1000)) AS INTEGER) AS hour,
       CAST(month(make_timestamp(timestamp_ms * 1000)) AS INTEGER) AS month
FROM quotes WHERE timestamp_ms IS NOT NULL""", exact=("price_eur_mwh",))
def _live_prices(f: Frames) -> DataFrame:
    from gridlake.operators import serving
    return serving.live_prices(_scored(f))


@register("live_prices_region", O.with_ctes("live") + f"""
SELECT event_time, region, {O.r('expected_price', 'price_eur_mwh')},
       CAST(hour(event_time) AS INTEGER) AS hour, CAST(month(event_time) AS INTEGER) AS month
FROM live WHERE region = 'AT'""")
def _live_region(f: Frames) -> DataFrame:
    from gridlake.operators import serving
    # a feed without a price column: the expected price is served
    return serving.live_prices(_scored(f).drop("price_eur_mwh"), region="AT")
