"""The single home of the cross-layer semantic decisions.

Every function returns a ``Column`` built from built-in expressions, so it stays inside
whole-stage codegen wherever it is used (batch, stream, serving).
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds used by the reference's models and stream (fixed values).
EXTREME_RAMP = 0.1          # |Δload / load| above this is an extreme ramp
DUNKELFLAUTE_SHARE = 0.1    # 24-row max renewable share below this is a dunkelflaute
ANOMALY_SIGMAS = 3.0        # batch anomaly band, mean ± 3σ
CRITICAL_Z = 3.0            # stream levels: z > 3 CRITICAL, z > 2 WARNING, z < -2 OPPORTUNITY
WARNING_Z = 2.0
OPPORTUNITY_Z = -2.0
BAND_Z = 1.96               # 95 % band of the serving layer


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dow(ts: Column | str) -> Column:
    """Day of week, one convention everywhere: 1 = Sunday … 7 = Saturday."""
    return F.dayofweek(_c(ts))


def safe_div(num: Column | str, den: Column | str) -> Column:
    """Division that yields NULL for a zero or NULL denominator (S1, ANSI stays on)."""
    return F.try_divide(_c(num), _c(den))


def surrogate_key(country: Column | str, ts: Column | str) -> Column:
    """md5 of zone + timestamp text; ``concat_ws`` skips NULLs like DuckDB's concat."""
    return F.md5(F.concat_ws("", _c(country), _c(ts).cast("string")))


def penetration(solar: Column | str, wind: Column | str, load: Column | str) -> Column:
    """Renewable penetration: (solar + wind) / load when load > 0, else 0 (also for NULL load)."""
    load = _c(load)
    return F.when(load > 0, (_c(solar) + _c(wind)) / load).otherwise(F.lit(0.0))


# Penetration buckets (upper bound exclusive, label, sort order).
PENETRATION_BUCKETS = [
    (0.2, "0-20%", 1),
    (0.4, "20-40%", 2),
    (0.6, "40-60%", 3),
    (0.8, "60-80%", 4),
    (None, "80%+", 5),
]


def penetration_bucket(rate: Column | str) -> Column:
    """struct(label, order) of the penetration bucket; NULL rate -> ('Unknown', 0)."""
    rate = _c(rate)
    expr = None
    lower = None
    for upper, label, order in PENETRATION_BUCKETS:
        cond = rate < upper if upper is not None else rate >= lower
        if lower is not None and upper is not None:
            cond = (rate >= lower) & cond
        value = F.struct(F.lit(label).alias("label"), F.lit(order).alias("order"))
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
        lower = upper
    return expr.otherwise(F.struct(F.lit("Unknown").alias("label"), F.lit(0).alias("order")))


def z_score(price: Column | str, mean: Column | str, std: Column | str) -> Column:
    """(price - mean) / std with NULL for σ = 0 or NULL."""
    return (_c(price) - _c(mean)) / F.nullif(_c(std), F.lit(0.0))


def anomaly_status(price: Column | str, mean: Column | str, std: Column | str, k: float = ANOMALY_SIGMAS) -> Column:
    """Batch status on differences, not on z: σ = 0 with price ≠ mean is still an anomaly."""
    price, mean, std = _c(price), _c(mean), _c(std)
    return (
        F.when((price - mean) > F.lit(k) * std, F.lit("High Anomaly"))
        .when((mean - price) > F.lit(k) * std, F.lit("Low Anomaly"))
        .otherwise(F.lit("Normal"))
    )


def anomaly_level(z: Column | str) -> Column:
    """Stream level; strict thresholds, NULL z -> NORMAL."""
    z = _c(z)
    return (
        F.when(z > CRITICAL_Z, F.lit("CRITICAL"))
        .when(z > WARNING_Z, F.lit("WARNING"))
        .when(z < OPPORTUNITY_Z, F.lit("OPPORTUNITY"))
        .otherwise(F.lit("NORMAL"))
    )


# Producer region -> bidding zone of the historical data.
REGION_TO_ZONE = {"DE": "DE_LU", "AT": "AT"}


def region_to_zone(region: Column | str) -> Column:
    """DE -> DE_LU, AT -> AT, anything else unchanged."""
    region = _c(region)
    expr = None
    for src, dst in REGION_TO_ZONE.items():
        expr = F.when(region == src, F.lit(dst)) if expr is None else expr.when(region == src, F.lit(dst))
    return expr.otherwise(region)


# The months of the seasons, and the first and last peak hour.
SEASONS = {"Winter": (12, 1, 2), "Spring": (3, 4, 5), "Summer": (6, 7, 8), "Autumn": (9, 10, 11)}
PEAK_HOURS = (8, 20)


def season(month: Column | str) -> Column:
    month = _c(month)
    return F.coalesce(*[F.when(month.isin(*months), F.lit(name)) for name, months in SEASONS.items()])


# Day names in Spark's dayofweek order (1 = Sunday … 7 = Saturday).
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]


def day_name(day_index: Column | str) -> Column:
    idx = _c(day_index)
    expr = None
    for i, name in enumerate(DAY_NAMES, start=1):
        expr = F.when(idx == i, F.lit(name)) if expr is None else expr.when(idx == i, F.lit(name))
    return expr


def is_weekend(day_index: Column | str) -> Column:
    """Sunday or Saturday in the 1–7 numbering."""
    return _c(day_index).isin(1, 7)


def is_peak_hour(hour: Column | str) -> Column:
    """08:00–20:00, both ends inclusive."""
    return _c(hour).between(*PEAK_HOURS)
