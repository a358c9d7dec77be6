"""Row order of marts and serving queries (H1–H3), and the schema that silver is read by."""
import random

from pyspark.sql import functions as F

from gridlake import schemas
from gridlake.operators import gold, serving
from gridlake.sinks import writers
from gridlake.sources import lake


def last(*values):
    """Ascending, NULL last."""
    return tuple((v is None, 0 if v is None else v) for v in values)


def fact(spark):
    """Hours of three zones and of one that has no name, over two years, in random order and partitions."""
    random.seed(11)
    rows = []
    for name, code in (("Poland", "PL"), ("Austria", "AT"), ("Zealand", "DK_2"), (None, "XX")):
        for year, month in ((2021, 12), (2021, 2), (2020, 11), (None, None)):
            for h in range(24):
                share = random.choice([0.0, 0.1, 0.3, 0.5, 0.7, 0.9, None])
                rows.append((name, code, year, month, f"2021-02-03 {h:02d}:00:00", share, float(h), random.choice([True, None])))
    random.shuffle(rows)
    df = spark.createDataFrame(rows, "country_name string, country_code string, year int, month int, t string, renewable_penetration_rate double, x double, flag boolean")
    numbers = {c: F.col("x") for c in ("price_eur_mwh", "load_mw", "solar_mw", "wind_mw", "residual_load_mw", "volatility_24h")}
    return df.withColumns({**numbers, "event_time": F.col("t").cast("timestamp_ntz"), "is_extreme_ramp": F.col("flag"), "is_dunkelflaute": F.col("flag")}).repartition(7)


def in_order(df, key):
    rows = df.collect()
    assert len(rows) > 5 and [key(r) for r in rows] == sorted(key(r) for r in rows)
    return rows


def test_marts_are_in_order(spark, tmp_path):
    f = fact(spark)
    marts = {
        "green": (gold.green_performance(f), lambda r: last(r["country_name"], r["year"], r["month"], r["bucket_sort_order"])),
        "risk": (gold.financial_risk(f), lambda r: last(r["country_name"], r["year"], r["month"])),
        "duck": (gold.duck_curve(f), lambda r: last(r["country_name"], r["year"], r["month"], r["hour_of_day"])),
    }
    for name, (mart, key) in marts.items():
        rows = in_order(mart, key)
        assert rows[-1]["country_name"] is None                       # names that are missing come last
        writers.write_gold(mart, str(tmp_path), name)
        assert sorted(map(key, lake.read_gold(spark, str(tmp_path), name).collect())) == [key(r) for r in rows]


def test_serving_queries_are_in_order(spark):
    f = fact(spark)
    green, risk, duck = gold.green_performance(f), gold.financial_risk(f), gold.duck_curve(f)
    in_order(serving.green_summary(green), lambda r: last(r["country_name"], r["year"], r["month"], r["bucket_sort_order"]))
    in_order(serving.risk_timeline(risk), lambda r: last(r["year"], r["month"], r["country_name"]))
    rows = in_order(serving.duck_curve_month(duck), lambda r: last(r["country_name"], r["year"], r["month"], r["hour_of_day"]))
    assert [r["hour_of_day"] for r in rows[:24]] == list(range(24))


def test_selected_years_descend(spark):
    green = gold.green_performance(fact(spark))
    bronze = spark.createDataFrame([("PL", "load_actual"), ("AT", "price_day_ahead")], "country string, metric_name string")
    values = serving.selector_values(green, bronze).orderBy("selector", "position").collect()
    years = [r["value"] for r in values if r["selector"] == "year"]
    assert years == ["2021", "2020"]


def test_first_rows_by_a_stated_order(spark):
    rows = spark.createDataFrame([(k % 3, k) for k in range(50)], "a int, b int").repartition(5)
    got = [tuple(r) for r in serving.first_n(rows, 4, F.col("a").desc()).collect()]
    assert got == [(2, 2), (2, 5), (2, 8), (2, 11)]


def test_silver_is_read_by_its_schema(spark, tmp_path):
    root = str(tmp_path / "features")
    frame = spark.createDataFrame([], schemas.SILVER_FEATURES)
    one = spark.range(1).select(*[(F.lit("2020-01-02 03:00:00") if f.name == "timestamp" else F.lit("AT") if f.name == "country" else F.lit(1)
                                   if f.name in ("year", "month", "day", "weekday", "hour") else F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.SILVER_FEATURES])
    writers.write_silver_features(frame.union(one), root)
    # a file of another writer lacks a column: it reads as NULL instead of changing the table's schema
    one.drop("volatility_24h", "country", "year").write.parquet(root + "/country=PL/year=2021")
    back = lake.read_silver_features(spark, root)
    assert sorted(back.dtypes) == sorted(frame.dtypes)
    assert {(r["country"], r["year"], r["volatility_24h"]) for r in back.collect()} == {("AT", 1, None), ("PL", 2021, None)}
    assert back.where("country = 'PL' AND year = 2021").count() == 1
