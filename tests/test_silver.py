import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridlake import schemas
from gridlake.operators import silver

METRICS = {"price": "price_day_ahead", "load": "load_actual_entsoe_transparency",
           "solar": "solar_generation_actual", "wind": "wind_generation_actual"}


def series(i):
    """Two days of our own: prices and load step by quarter of the day, the sun shines for eight hours, wind alternates."""
    quarter = i // 6
    return {
        "price": [41.5, 63.25, 77.0, 52.75][quarter % 4] + i / 16,
        "load": [8100.0, 9400.0, 9900.0, 8600.0][quarter % 4] + 25 * i,
        "solar": [0.0, 900.0, 1450.0, 0.0][quarter % 4],
        "wind": 1300.0 if i % 2 else 1720.0,
    }


def bronze_rows(zone, hours, fn, start=dt.datetime(2020, 1, 1)):
    rows = []
    for i in hours:
        ts = start + dt.timedelta(hours=i)
        for key, value in fn(i).items():
            if value is None:
                continue
            rows.append((ts, zone, METRICS[key], float(value), str(ts.year), f"{ts.month:02d}"))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, schemas.BRONZE)


def test_pivot_shape_and_zero_fill(spark):
    rows = bronze_rows("DE_LU", range(48), series)
    rows += [(dt.datetime(2020, 1, 1), "DE_LU", "error_count", 1.0, "2020", "01")]   # "other" is dropped
    rows += [(dt.datetime(2020, 1, 5), "AT", "price_day_ahead", 10.0, "2020", "01")]  # no generation -> 0
    wide = silver.pivot_metrics(frame(spark, rows))
    assert wide.columns == ["timestamp", "country", "load", "price", "solar", "wind"]
    assert wide.where("country = 'DE_LU'").count() == 48
    at = wide.where("country = 'AT'").first()
    assert at["solar"] == 0.0 and at["wind"] == 0.0 and at["load"] is None


def test_features_fixture(spark):
    feats = silver.features(silver.pivot_metrics(frame(spark, bronze_rows("DE_LU", range(48), series))))
    rows = feats.orderBy("timestamp").collect()
    assert feats.columns == schemas.SILVER_FEATURE_COLUMNS
    assert len(rows) == 48
    assert rows[0]["prev_load"] is None
    assert all(r["volatility_24h"] is None and r["is_dunkelflaute"] is None for r in rows[:23])
    assert all(r["volatility_24h"] is not None and r["is_dunkelflaute"] is not None for r in rows[23:])
    assert not any(r["is_window_valid"] for r in rows[:23]) and all(r["is_window_valid"] for r in rows[23:])
    r5 = rows[5]
    exp = series(5)
    assert r5["residual_load"] == exp["load"] - (exp["solar"] + exp["wind"])
    assert r5["prev_load"] == series(4)["load"]
    assert abs(r5["ramp_rate_pct"] - abs((exp["load"] - series(4)["load"]) / exp["load"])) < 1e-12
    assert r5["weekday"] == 4 and r5["hour"] == 5       # 2020-01-01 was a Wednesday (1 = Sunday)
    assert all(r["is_dunkelflaute"] is False for r in rows[23:])   # plenty of renewables


def test_dunkelflaute_and_edge_values(spark):
    def low(i):
        v = {"price": 50.0 if i != 30 else None, "load": 10000.0, "solar": 0.0, "wind": 500.0}
        if i == 40:
            v["load"] = 0.0          # share undefined, ramp undefined: no error
        return v
    rows = bronze_rows("NO_2", range(48), low)
    feats = silver.features(silver.pivot_metrics(frame(spark, rows)))
    got = {r["timestamp"].hour + 24 * (r["timestamp"].day - 1): r for r in feats.collect()}
    assert got[23]["is_dunkelflaute"] is True
    assert got[40]["renewable_share"] is None and got[40]["ramp_rate_pct"] is None
    assert got[40]["is_extreme_ramp"] is False
    assert got[30]["price"] is None and got[30]["volatility_24h"] == 0.0


def naive(wide, hours=24):
    w = Window.partitionBy("country").orderBy("timestamp")
    frame_ = w.rowsBetween(-(hours - 1), 0)
    base = silver.power_columns(wide).withColumn("renewable_share", F.try_divide("renewable_gen", "load"))
    return base.select(
        "timestamp", "country",
        (F.row_number().over(w) >= hours).alias("is_window_valid"),
        F.lag("load").over(w).alias("prev_load"),
        F.when(F.row_number().over(w) >= hours, F.stddev_samp("price").over(frame_)).alias("volatility_24h"),
        F.max("renewable_share").over(frame_).alias("max_share_last_24h"),
    )


def noisy_wide(spark):
    rnd = random.Random(7)

    def noisy(i):
        return {"price": rnd.choice([None, rnd.uniform(-50, 300)]), "load": rnd.uniform(100, 1000),
                "solar": rnd.uniform(0, 50), "wind": rnd.uniform(0, 50)}
    rows = []
    for zone in ["DE_LU", "AT", "SE_1"]:
        hours = sorted(rnd.sample(range(24 * 20), 300))        # gaps of random length
        rows += bronze_rows(zone, hours, noisy)
    return silver.pivot_metrics(frame(spark, rows))


def test_windows_over_gaps(spark):
    wide = noisy_wide(spark)
    got = silver.features(wide).select(
        "timestamp", "country", "is_window_valid", "prev_load", "volatility_24h", "max_share_last_24h")
    key = lambda r: (r["country"], r["timestamp"])
    a, b = sorted(got.collect(), key=key), sorted(naive(wide).collect(), key=key)
    assert len(a) == len(b) == 900
    for x, y in zip(a, b):
        assert x["is_window_valid"] == y["is_window_valid"]
        assert x["prev_load"] == y["prev_load"]
        assert x["max_share_last_24h"] == y["max_share_last_24h"]
        if y["volatility_24h"] is None:
            assert x["volatility_24h"] is None
        else:
            assert abs(x["volatility_24h"] - y["volatility_24h"]) < 1e-9


def test_range_frame_over_gaps(spark):
    """``frame="range"`` sees the last 24 hours, not the last 24 rows."""
    rows = [r.asDict() for r in silver.features(noisy_wide(spark), frame="range").collect()]
    assert len(rows) == 900
    day = dt.timedelta(hours=23)
    for zone in ("DE_LU", "AT", "SE_1"):
        own = sorted((r for r in rows if r["country"] == zone), key=lambda r: r["timestamp"])
        for r in own:
            recent = [x["renewable_share"] for x in own if r["timestamp"] - day <= x["timestamp"] <= r["timestamp"]]
            assert r["max_share_last_24h"] == max(recent)
            assert r["is_window_valid"] == (r["timestamp"] - own[0]["timestamp"] >= day)
            assert (r["is_dunkelflaute"] is None) == (not r["is_window_valid"])
    with pytest.raises(ValueError):
        silver.features(noisy_wide(spark), frame="days")


def test_rows_without_zone_or_time_stay(spark):
    schema = "timestamp timestamp_ntz, country string, load double, price double, solar double, wind double"
    t = dt.datetime(2021, 1, 1)
    wide = spark.createDataFrame([(t, None, 10.0, 1.0, 1.0, 0.0), (None, "AT", 20.0, 1.0, 2.0, 0.0),
                                  (t, "AT", 40.0, 1.0, 4.0, 0.0), (None, None, 5.0, None, 0.0, 0.0)], schema)
    for kind in ("rows", "range"):
        got = {(r["timestamp"], r["country"]): r["prev_load"] for r in silver.features(wide, frame=kind).collect()}
        assert got == {(t, None): 5.0, (None, "AT"): None, (t, "AT"): 20.0, (None, None): None}


def test_price_profile_single_sample_and_equal_prices(spark):
    rows = bronze_rows("DE_LU", [0], lambda i: {"price": 40.0, "load": 1.0})
    rows += bronze_rows("AT", [0, 24 * 7], lambda i: {"price": 25.0, "load": 1.0})
    prof = {(r["country"]): r for r in silver.price_profile(
        silver.features(silver.pivot_metrics(frame(spark, rows)))).collect()}
    assert prof["DE_LU"]["stddev_price_baseline"] is None and prof["DE_LU"]["sample_size"] == 1
    assert prof["AT"]["stddev_price_baseline"] == 0.0 and prof["AT"]["sample_size"] == 2
