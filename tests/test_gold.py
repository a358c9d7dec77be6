import datetime as dt

from pyspark.sql import functions as F

from gridlake.functions import semantics as S
from gridlake.operators import gold
from gridlake.sources.spine import spine_rows


def test_dim_date_reference_span(spark):
    start, end = dt.datetime(2014, 12, 31, 23), dt.datetime(2020, 10, 1, 0)
    assert spine_rows(start, end) == 50401
    d = gold.dim_date(spark, start, end)
    assert d.count() == 50401
    first = d.orderBy("time_key").first()
    assert first["time_key"] == start and first["day_of_week_index"] == 4 and first["day_of_week_name"] == "Wednesday"
    sat = d.where(F.col("time_key") == dt.datetime(2020, 1, 4, 8)).first()
    assert sat["is_weekend"] is True and sat["is_peak_hour"] is True and sat["season"] == "Winter"
    assert d.where(F.col("time_key") == dt.datetime(2020, 1, 6, 21)).first()["is_peak_hour"] is False


def test_penetration_buckets(spark):
    vals = [(None,), (0.0,), (0.19999,), (0.2,), (0.4,), (0.6,), (0.79,), (0.8,), (3.0,)]
    df = spark.createDataFrame(vals, "r double").select("r", S.penetration_bucket("r").alias("b"))
    got = [(r["b"]["label"], r["b"]["order"]) for r in df.collect()]
    assert got == [("Unknown", 0), ("0-20%", 1), ("0-20%", 1), ("20-40%", 2), ("40-60%", 3), ("60-80%", 4),
                   ("60-80%", 4), ("80%+", 5), ("80%+", 5)]
    pen = spark.createDataFrame([(1.0, 2.0, None), (1.0, 2.0, 0.0), (1.0, 2.0, 10.0)], "s double, w double, l double")
    assert [r[0] for r in pen.select(S.penetration("s", "w", "l")).collect()] == [0.0, 0.0, 0.3]


def test_anomaly_status_and_level(spark):
    df = spark.createDataFrame(
        [(10.0, 10.0, 0.0), (11.0, 10.0, 0.0), (9.0, 10.0, 0.0), (16.0, 10.0, 2.0), (17.0, 10.0, 2.0),
         (3.0, 10.0, 2.0), (5.0, 10.0, None)],
        "p double, m double, s double",
    ).select(S.anomaly_status("p", "m", "s").alias("st"), S.z_score("p", "m", "s").alias("z"))
    rows = df.collect()
    assert [r["st"] for r in rows] == ["Normal", "High Anomaly", "Low Anomaly", "Normal", "High Anomaly",
                                       "Low Anomaly", "Normal"]
    assert rows[0]["z"] is None and rows[3]["z"] == 3.0
    lv = spark.createDataFrame([(3.0,), (3.01,), (2.0,), (2.5,), (-2.0,), (-2.01,), (None,)], "z double") \
        .select(S.anomaly_level("z").alias("l"))
    assert [r["l"] for r in lv.collect()] == ["WARNING", "CRITICAL", "NORMAL", "WARNING", "NORMAL", "OPPORTUNITY",
                                              "NORMAL"]


def _fact(spark, rows):
    schema = ("energy_event_id string, event_time timestamp_ntz, country_code string, country_name string, "
              "year int, month int, price_eur_mwh double, load_mw double, is_dunkelflaute boolean")
    return spark.createDataFrame(rows, schema)


def test_financial_risk(spark):
    t = dt.datetime(2020, 1, 1)
    rows = [
        ("a", t, "DE_LU", "Germany-Luxembourg", 2020, 1, 100.0, 10.0, True),
        ("b", t + dt.timedelta(hours=1), "DE_LU", "Germany-Luxembourg", 2020, 1, 50.0, 20.0, False),
        ("c", t + dt.timedelta(hours=2), "DE_LU", "Germany-Luxembourg", 2020, 1, None, 30.0, True),
        ("d", t + dt.timedelta(hours=3), "DE_LU", "Germany-Luxembourg", 2020, 1, 60.0, 40.0, None),
    ]
    risk = gold.financial_risk(_fact(spark, rows)).collect()
    assert len(risk) == 1
    r = risk[0]
    base = (100 + 50 + 60) / 3
    assert r["hours_in_dunkelflaute"] == 1 and r["priced_load_mwh_at_risk"] == 10.0
    assert abs(r["total_dunkelflaute_cost_eur"] - (100 - base) * 10) < 1e-9
    assert abs(r["risk_premium_per_mwh"] - (100 - base)) < 1e-9


def test_price_anomaly_keys_use_one_weekday_convention(spark):
    sunday = dt.datetime(2020, 1, 5, 10)
    fact = _fact(spark, [("a", sunday, "AT", "Austria", 2020, 1, 90.0, 1.0, False)])
    base = spark.createDataFrame([("AT", 1, 1, 10, 50.0, 10.0)],
                                 "country_code string, month_of_year int, day_of_week int, hour_of_day int, "
                                 "avg_price_baseline double, stddev_price_baseline double")
    out = gold.price_anomaly(fact, base).collect()
    assert len(out) == 1 and out[0]["anomaly_status"] == "High Anomaly" and out[0]["price_z_score"] == 4.0


def test_surrogate_key_matches_sql_text(spark):
    df = spark.createDataFrame([("DE_LU", dt.datetime(2020, 1, 1, 0))], "c string, t timestamp_ntz")
    import hashlib
    assert df.select(S.surrogate_key("c", "t")).first()[0] == hashlib.md5(b"DE_LU2020-01-01 00:00:00").hexdigest()
