import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from gridlake.operators import quality, serving
from gridlake.sources import lake, payload, topic
from gridlake.sinks import writers
from gridlake import schemas


def test_checks(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", None), (None, 3)], "k string, v int")
    u = quality.unique(df, "t", "k").first()
    assert u["failing_rows"] == 1 and u["passed"] is False
    nn = {r["column"]: r["failing_rows"] for r in quality.not_null(df, "t", ["k", "v"]).collect()}
    assert nn == {"k": 1, "v": 1}
    both = {(r["check"], r["column"]): r["failing_rows"] for r in quality.key(df, "t", "k", {"v": "warn"}).collect()}
    assert both == {("unique", "k"): 1, ("not_null", "k"): 1, ("not_null", "v"): 1}
    none = quality.key(df.limit(0), "t", "k").collect()
    assert [r["failing_rows"] for r in none] == [0, 0] and all(r["passed"] for r in none)
    fact = spark.createDataFrame([("DE_LU",), ("FR",), ("FR",), (None,)], "country_code string")
    dim = spark.createDataFrame([("DE_LU",), ("AT",)], "country_code string")
    rel = quality.relationship(fact, "fct", "country_code", dim, "country_code").first()
    assert rel["failing_rows"] == 2
    assert [tuple(r) for r in quality.orphans(fact, "country_code", dim, "country_code").collect()] == [("FR", 2)]
    diff = {(r["zone"], r["status"]) for r in quality.zone_set_diff(
        fact.withColumnRenamed("country_code", "country"), dim.withColumnRenamed("country_code", "country")).collect()}
    assert diff == {("FR", "unexpected"), ("AT", "missing")}
    bronze = spark.createDataFrame([("SE_2", "price_day_ahead"), ("SE_2", "load_actual")], "country string, metric_name string")
    assert quality.keywords(bronze, "bronze").first()["failing_rows"] == 1          # no "generation"
    assert quality.subzone_check(bronze, "bronze").first()["failing_rows"] == 1     # SE_* but no SE_1
    assert quality.min_rows(bronze, "bronze", 5).first()["failing_rows"] == 3
    cp = quality.columns_present(spark, bronze, "bronze").first()
    assert cp["failing_rows"] == 4 and cp["passed"] is False


def test_payload_points_and_messages(spark, tmp_path):
    hour, start = 3_600_000, 1_625_824_800_000          # 2021-07-09 10:00 UTC
    prices = [0.0, -41.07, 118.93, 64.2]
    doc = {"data": [{"start_timestamp": start + k * hour, "end_timestamp": start + (k + 1) * hour, "marketprice": p,
                     "unit": "Eur/MWh"} for k, p in enumerate(prices)]}
    (tmp_path / "de.json").write_text(json.dumps(doc, indent=2))
    (tmp_path / "empty.json").write_text('{"data": []}')
    pts = payload.price_points(payload.read_payload(spark, str(tmp_path / "de.json"), region="DE"))
    rows = pts.orderBy("start_timestamp").collect()
    assert [r["price_eur_mwh"] for r in rows] == prices
    assert rows[1]["event_time"] == dt.datetime(2021, 7, 9, 11) and rows[1]["hour"] == 11
    assert payload.price_points(payload.read_payload(spark, str(tmp_path / "empty.json"), "AT")).count() == 0
    msg = json.loads(writers.publish_messages(pts, ingested_at=1.5).orderBy("value").first()["value"])
    assert set(msg) == {"timestamp_ms", "price_eur_mwh", "unit", "region", "ingested_at"}
    snap = writers.snapshot_rows(pts, ingestion_time="2024-02-01 00:00:00").first()
    assert snap["snapshot_date"] == "20240201" and snap["region"] == "DE"
    writers.write_snapshot(writers.snapshot_rows(pts, "2024-02-01 00:00:00"), str(tmp_path / "snap"))
    assert (tmp_path / "snap" / "region=DE" / "snapshot_date=20240201").exists()


def test_processing_time_is_the_default(spark):
    points = spark.createDataFrame([(0, 1, 5.0, "Eur/MWh", "DE")], "start_timestamp long, end_timestamp long, marketprice double, unit string, region string")
    before = dt.datetime.now(dt.timezone.utc)
    sent = json.loads(writers.publish_messages(points).first()["value"])["ingested_at"]
    snap = writers.snapshot_rows(points).first()
    after = dt.datetime.now(dt.timezone.utc)
    assert before.timestamp() - 1 <= sent <= after.timestamp() + 1
    taken = dt.datetime.fromisoformat(snap["ingestion_time"]).replace(tzinfo=dt.timezone.utc)
    assert before - dt.timedelta(seconds=1) <= taken <= after + dt.timedelta(seconds=1)
    assert snap["snapshot_date"] in {before.strftime("%Y%m%d"), after.strftime("%Y%m%d")}


def test_serving(spark):
    duck = spark.createDataFrame(
        [("X", 2020, 6, h, 100.0 - (30 if 10 <= h <= 14 else 0) + (20 if h == 18 else 0)) for h in range(24)],
        "country_name string, year int, month int, hour_of_day int, avg_net_load double")
    shape = serving.duck_shape(duck).first()
    assert shape["min_net_load"] == 70.0 and shape["max_ramp"] == 30.0
    risk = spark.createDataFrame([("A", 2020, 1, 2, 10.0, 100.0), ("B", 2020, 1, 0, 0.0, 0.0)],
                                 "country_name string, year int, month int, hours_in_dunkelflaute long, "
                                 "priced_load_mwh_at_risk double, total_dunkelflaute_cost_eur double")
    k = serving.risk_kpis(risk).first()
    assert k["total_hours"] == 2 and k["avg_premium"] == 10.0
    assert serving.risk_kpis(risk, ["B"]).first()["avg_premium"] is None
    assert serving.risk_timeline(risk).first()["date_str"] == "2020-01"


def test_historical_band_fallback(spark):
    fact = spark.createDataFrame(
        [("AT", dt.datetime(2020, 3, 1, h), 10.0 + d) for h in (0, 1) for d in (0, 2)]
        + [("AT", dt.datetime(2020, 4, 1, 0), 30.0)],
        "country_code string, event_time timestamp_ntz, price_eur_mwh double")
    live_june = spark.createDataFrame([("AT", dt.datetime(2024, 6, 1, 0))], "country_code string, event_time timestamp")
    band = serving.historical_band(fact, live_june, factor=1.0).orderBy("hour").collect()
    assert [r["basis"] for r in band] == ["all_months", "all_months"]
    assert band[0]["hist_mean"] == (11.0 + 30.0) / 2
    live_march = spark.createDataFrame([("AT", dt.datetime(2024, 3, 1, 0))], "country_code string, event_time timestamp")
    band = serving.historical_band(fact, live_march, factor=3.0).orderBy("hour").collect()
    assert [r["basis"] for r in band] == ["month", "month"] and band[0]["hist_mean"] == 33.0


def test_live_prices(spark):
    schema = "event_time timestamp, region string, price_eur_mwh double, expected_price double"
    empty = spark.createDataFrame([], schema)
    at = dt.datetime(2024, 1, 1, 5)
    snap = spark.createDataFrame([(at, "DE", 7.5)], "event_time timestamp, region string, price_eur_mwh double")
    r = serving.live_prices(empty, snap).first()
    assert r["price_eur_mwh"] == 7.5 and r["hour"] == 5
    live = spark.createDataFrame([(at, "DE", None, 50.0), (at.replace(hour=3), "DE", 1.0, 50.0), (at, "AT", 2.0, None)], schema)
    # a NULL price stays NULL; only a missing column falls back
    assert [r["price_eur_mwh"] for r in serving.live_prices(live, snap, region="DE").collect()] == [1.0, None]
    assert {r["price_eur_mwh"] for r in serving.live_prices(live.drop("price_eur_mwh"), region="DE").collect()} == {50.0}
    bare = live.drop("price_eur_mwh", "expected_price")
    assert {r["price_eur_mwh"] for r in serving.live_prices(bare).collect()} == {0.0}


def test_tables_that_are_not_there_yet(spark, tmp_path):
    live = lake.read_realtime(spark, str(tmp_path / "nothing"))
    assert live.count() == 0
    snap = spark.createDataFrame([(dt.datetime(2024, 1, 1, 5), "DE", 7.5)], "event_time timestamp, region string, price_eur_mwh double")
    assert serving.live_prices(live, snap).count() == 1
    assert lake.read_gold(spark, str(tmp_path), "mart", "a int").columns == ["a"]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        lake.read_gold(spark, str(tmp_path), "mart").count()


def test_orders(spark):
    rows = [("B", 2020, 1, 2, 3.0, 1.0), ("A", None, 5, 1, 1.0, 1.0), ("A", 2020, 2, 5, 2.0, 1.0), ("A", 2020, 2, 1, 2.0, 1.0), ("C", 2019, 1, 1, None, 1.0)]
    green = spark.createDataFrame(rows, "country_name string, year int, month int, bucket_sort_order int, avg_price_volatility double, avg_residual_load double")
    got = [(r["country_name"], r["year"], r["bucket_sort_order"]) for r in serving.green_summary(green).collect()]
    assert got == [("A", 2020, 1), ("A", 2020, 5), ("A", None, 1), ("B", 2020, 2)]
    first = serving.first_n(green, 3, F.col("year").desc_nulls_last()).select("country_name", "bucket_sort_order").collect()
    assert [tuple(r) for r in first] == [("A", 1), ("A", 5), ("B", 2)]


def test_gate_and_one_scan_of_bronze(spark):
    schema = "timestamp timestamp_ntz, country string, metric_name string, value double"
    t = dt.datetime(2021, 1, 1)
    rows = [(t, "SE_2", "price_day_ahead", 1.0), (None, "AT", "load_actual", None), (t, None, "load_actual", 2.0)]
    report = quality.bronze_checks(spark.createDataFrame(rows, schema), "bronze", ["AT", "SE_1"], minimum=5)
    got = {(r["check"], r["column"]): r["failing_rows"] for r in report.collect()}
    assert got == {("min_rows", None): 2, ("metric_keywords", "metric_name"): 1, ("subzones", "country"): 1, ("not_null", "country"): 1,
                   ("not_null", "timestamp"): 1, ("not_null", "value"): 1, ("zones_unexpected", "country"): 1, ("zones_missing", "country"): 1}
    with pytest.raises(quality.QualityError, match="zones_unexpected bronze.country: 1"):
        quality.gate(report)
    warnings = report.where("severity = 'warn'")
    assert quality.gate(warnings).count() == 4
    empty = quality.bronze_checks(spark.createDataFrame([], schema), "bronze", ["AT"], minimum=5)
    assert {(r["check"], r["failing_rows"]) for r in empty.collect()} >= {("min_rows", 5), ("zones_missing", 1), ("not_null", 0)}


def test_topic_options():
    assert topic.topic_options("h:1", "prices", "earliest", failOnDataLoss="false") == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "prices", "startingOffsets": "earliest", "failOnDataLoss": "false"}
