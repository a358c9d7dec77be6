"""Explicit schemas at every boundary, and the seed tables.

Column orders follow the layer contracts in SURVEY §1.4.
"""
from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------------------
# Bronze (long) — one measurement per row; year/month are Hive partition columns.
# --------------------------------------------------------------------------------------
BRONZE = T.StructType(
    [
        T.StructField("timestamp", T.TimestampNTZType(), False),
        T.StructField("country", T.StringType(), False),
        T.StructField("metric_name", T.StringType(), False),
        T.StructField("value", T.DoubleType(), True),
        T.StructField("year", T.StringType(), False),
        T.StructField("month", T.StringType(), False),
    ]
)
BRONZE_COLUMNS = [f.name for f in BRONZE.fields]

# Read-back schema: partition values come back from the paths as integers.
BRONZE_READ = T.StructType(
    [
        T.StructField("timestamp", T.TimestampNTZType(), True),
        T.StructField("country", T.StringType(), True),
        T.StructField("metric_name", T.StringType(), True),
        T.StructField("value", T.DoubleType(), True),
        T.StructField("year", T.IntegerType(), True),
        T.StructField("month", T.IntegerType(), True),
    ]
)

def _fields(kind: T.DataType, *names: str) -> list[T.StructField]:
    return [T.StructField(n, kind, True) for n in names]


# Silver features, in the order of the contract; country and year come back from the partition paths.
SILVER_FEATURES = T.StructType(
    _fields(T.TimestampNTZType(), "timestamp")
    + _fields(T.StringType(), "country")
    + _fields(T.DoubleType(), "load", "price", "solar", "wind", "renewable_gen", "residual_load")
    + _fields(T.BooleanType(), "is_window_valid")
    + _fields(T.DoubleType(), "prev_load", "load_diff", "ramp_rate_pct")
    + _fields(T.BooleanType(), "is_extreme_ramp")
    + _fields(T.DoubleType(), "volatility_24h", "renewable_share", "max_share_last_24h")
    + _fields(T.BooleanType(), "is_dunkelflaute")
    + _fields(T.IntegerType(), "year", "month", "day", "weekday", "hour")
)
SILVER_FEATURE_COLUMNS = SILVER_FEATURES.names

PRICE_PROFILE = T.StructType(
    [
        T.StructField("country", T.StringType(), True),
        T.StructField("month", T.IntegerType(), True),
        T.StructField("weekday", T.IntegerType(), True),
        T.StructField("hour", T.IntegerType(), True),
        T.StructField("avg_price_baseline", T.DoubleType(), True),
        T.StructField("stddev_price_baseline", T.DoubleType(), True),
        T.StructField("sample_size", T.LongType(), True),
    ]
)

# --------------------------------------------------------------------------------------
# Live feed: the price API payload and the published message.
# --------------------------------------------------------------------------------------
PRICE_POINT = T.StructType(
    [
        T.StructField("start_timestamp", T.LongType(), True),
        T.StructField("end_timestamp", T.LongType(), True),
        T.StructField("marketprice", T.DoubleType(), True),
        T.StructField("unit", T.StringType(), True),
    ]
)
PAYLOAD = T.StructType([T.StructField("data", T.ArrayType(PRICE_POINT), True)])

# Fields the stream parses; the published ``unit`` is not among them and is dropped.
STREAM_MESSAGE = T.StructType(
    [
        T.StructField("timestamp_ms", T.LongType(), True),
        T.StructField("price_eur_mwh", T.DoubleType(), True),
        T.StructField("region", T.StringType(), True),
        T.StructField("ingested_at", T.DoubleType(), True),
    ]
)

REALTIME_COLUMNS = ["event_time", "region", "price_eur_mwh", "expected_price", "z_score", "anomaly_level"]

# --------------------------------------------------------------------------------------
# Seeds
# --------------------------------------------------------------------------------------
COUNTRY_SEED = T.StructType(
    [
        T.StructField("code", T.StringType(), False),
        T.StructField("country_name", T.StringType(), True),
        T.StructField("eu_region", T.StringType(), True),
    ]
)
METRIC_SEED = T.StructType(
    [
        T.StructField("metric_code", T.StringType(), False),
        T.StructField("metric_name", T.StringType(), True),
        T.StructField("category", T.StringType(), True),
        T.StructField("is_renewable", T.BooleanType(), True),
        T.StructField("unit", T.StringType(), True),
    ]
)

# The bidding-zone seed (code, country_name, eu_region), 32 rows, as published.
COUNTRY_ROWS = [
    ("AT", "Austria", "Central Europe"),
    ("DE_LU", "Germany-Luxembourg", "Central Europe"),
    ("DK_1", "Denmark (Jutland)", "Northern Europe"),
    ("DK_2", "Denmark (Zealand)", "Northern Europe"),
    ("GB_GBN", "Great Britain", "Western Europe"),
    ("IE_sem", "Ireland (SEM)", "Western Europe"),
    ("IT_BRNN", "Italy (Brindisi)", "Southern Europe"),
    ("IT_CNOR", "Italy (Central North)", "Southern Europe"),
    ("IT_CSUD", "Italy (Central South)", "Southern Europe"),
    ("IT_FOGN", "Italy (Foggia)", "Southern Europe"),
    ("IT_GR", "Italy-Greece Interconnector", "Southern Europe"),
    ("IT_NORD", "Italy (North)", "Southern Europe"),
    ("IT_NORD_AT", "Italy-Austria Interconnector", "Southern Europe"),
    ("IT_NORD_CH", "Italy-Switzerland Interconnector", "Southern Europe"),
    ("IT_NORD_FR", "Italy-France Interconnector", "Southern Europe"),
    ("IT_NORD_SI", "Italy-Slovenia Interconnector", "Southern Europe"),
    ("IT_PRGP", "Italy (Priolo Gargallo)", "Southern Europe"),
    ("IT_ROSN", "Italy (Rossano)", "Southern Europe"),
    ("IT_SACO_AC", "Italy-Corsica AC", "Southern Europe"),
    ("IT_SACO_DC", "Italy-Corsica DC", "Southern Europe"),
    ("IT_SARD", "Italy (Sardinia)", "Southern Europe"),
    ("IT_SICI", "Italy (Sicily)", "Southern Europe"),
    ("IT_SUD", "Italy (South)", "Southern Europe"),
    ("NO_1", "Norway (Oslo)", "Northern Europe"),
    ("NO_2", "Norway (Kristiansand)", "Northern Europe"),
    ("NO_3", "Norway (Trondheim)", "Northern Europe"),
    ("NO_4", "Norway (Tromsø)", "Northern Europe"),
    ("NO_5", "Norway (Bergen)", "Northern Europe"),
    ("SE_1", "Sweden (Luleå)", "Northern Europe"),
    ("SE_2", "Sweden (Sundsvall)", "Northern Europe"),
    ("SE_3", "Sweden (Stockholm)", "Northern Europe"),
    ("SE_4", "Sweden (Malmö)", "Northern Europe"),
]

# The metric seed (metric_code, metric_name, category, is_renewable, unit), 5 rows.
METRIC_ROWS = [
    ("price", "Day-Ahead Price", "Market", False, "EUR/MWh"),
    ("load", "Total Load", "Consumption", False, "MW"),
    ("solar", "Solar Generation", "Generation", True, "MW"),
    ("wind", "Wind Generation", "Generation", True, "MW"),
    ("residual_load", "Net Residual Load", "Computed", False, "MW"),
]
