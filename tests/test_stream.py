import datetime as dt
import json
import os

import pytest

from gridlake.operators import gold
from gridlake.sinks import batches
from gridlake.sources import lake
from gridlake.streaming import corrections, lookup, scoring

BASELINES_SCHEMA = ("country_code string, month_of_year int, day_of_week int, hour_of_day int, "
                    "avg_price_baseline double, stddev_price_baseline double")
# 2024-11-12 22:13:20 UTC is a Tuesday (day 3), hour 22, month 11
T0 = 1_731_449_600_000


def baselines(spark):
    return spark.createDataFrame(
        [("DE_LU", 11, 3, 22, 50.0, 10.0), ("AT", 11, 3, 22, 50.0, 0.0), ("DE_LU", 11, 3, 22, 50.0, 10.0)],
        BASELINES_SCHEMA,
    )


def messages(spark, prices, region="DE"):
    vals = [json.dumps({"timestamp_ms": T0, "price_eur_mwh": p, "unit": "Eur/MWh", "region": region,
                        "ingested_at": 1.0}) for p in prices]
    return spark.createDataFrame([(v,) for v in vals] + [("{not json",)], "value string")


def test_decode_split_and_score(spark):
    good, bad = scoring.split_bad(scoring.decode(messages(spark, [70.0, 80.0, 80.5, 30.0, 29.0, 50.0])))
    assert bad.count() == 1
    out = scoring.score(good, baselines(spark)).orderBy("price_eur_mwh").collect()
    levels = {r["price_eur_mwh"]: r["anomaly_level"] for r in out}
    # thresholds are strict: z = 2 is NORMAL, z = 3 is WARNING, z = -2 is NORMAL
    assert levels == {29.0: "OPPORTUNITY", 30.0: "NORMAL", 50.0: "NORMAL", 70.0: "NORMAL", 80.0: "WARNING",
                      80.5: "CRITICAL"}
    assert all(r["expected_price"] == 50.0 for r in out)
    assert out[0]["event_time"] == dt.datetime(2024, 11, 12, 22, 13, 20)


def test_sigma_zero_and_unknown_region(spark):
    good, _ = scoring.split_bad(scoring.decode(messages(spark, [80.0], region="AT")))
    r = scoring.score(good, baselines(spark)).first()
    assert r["z_score"] is None and r["anomaly_level"] == "NORMAL"
    good, _ = scoring.split_bad(scoring.decode(messages(spark, [80.0], region="FR")))
    r = scoring.score(good, baselines(spark)).first()
    assert r["expected_price"] is None and r["anomaly_level"] == "NORMAL" and r["region"] == "FR"


def test_streaming_file_source_available_now(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    lines = [json.dumps({"timestamp_ms": T0, "price_eur_mwh": p, "unit": "Eur/MWh", "region": "DE",
                         "ingested_at": 1.0}) for p in (80.5, 50.0)]
    (src / "batch1.txt").write_text("\n".join(lines + ["garbage"]) + "\n")
    stream = spark.readStream.format("text").load(str(src))
    out, dead, ck = str(tmp_path / "out"), str(tmp_path / "dead"), str(tmp_path / "ck")
    qs = scoring.start_scoring(stream, baselines(spark), out, ck, trigger={"availableNow": True},
                               dead_letter_path=dead)
    for q in qs:
        q.awaitTermination(120)
    rows = spark.read.parquet(out).collect()
    assert sorted(r["anomaly_level"] for r in rows) == ["CRITICAL", "NORMAL"]
    assert [r["value"] for r in spark.read.parquet(dead).collect()] == ["garbage"]


def test_republished_duplicates_dropped(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    line = json.dumps({"timestamp_ms": T0, "price_eur_mwh": 80.5, "unit": "Eur/MWh", "region": "DE",
                       "ingested_at": 1.0})
    (src / "a.txt").write_text("\n".join([line, line, line]) + "\n")
    stream = spark.readStream.format("text").load(str(src))
    out = str(tmp_path / "out")
    qs = scoring.start_scoring(stream, baselines(spark), out, str(tmp_path / "ck"),
                               trigger={"availableNow": True}, dedupe=True)
    for q in qs:
        q.awaitTermination(120)
    assert spark.read.parquet(out).count() == 1


def test_scoring_needs_utc(spark):
    good, _ = scoring.split_bad(scoring.decode(messages(spark, [80.0])))
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        with pytest.raises(ValueError, match="UTC"):
            scoring.score(good, baselines(spark))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_late_first_list_keeps_all_its_hours(spark, tmp_path):
    """Three lists of one region arrive before another region's first one: none of its hours is taken for late."""
    src = tmp_path / "in"
    src.mkdir()
    hour = 3_600_000
    for k, region in enumerate(["DE", "DE", "DE", "AT", "AT"]):
        lines = [json.dumps({"timestamp_ms": T0 + h * hour, "price_eur_mwh": 1.0 + h, "unit": "Eur/MWh", "region": region,
                             "ingested_at": T0 / 1000 + 60.0 * k}) for h in range(24)]
        (src / f"{k}.txt").write_text("\n".join(lines) + "\n")
        os.utime(src / f"{k}.txt", (1_700_000_000 + k, 1_700_000_000 + k))
    stream = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(str(src))
    out = str(tmp_path / "out")
    for q in scoring.start_scoring(stream, baselines(spark), out, str(tmp_path / "ck"), trigger={"availableNow": True}, dedupe=True):
        q.awaitTermination(300)
    got = {r["region"]: r["count"] for r in spark.read.parquet(out).groupBy("region").count().collect()}
    assert got == {"DE": 24, "AT": 24}


# --- one read, refreshed baselines, corrections, batches of the sink

def published(prices, region="DE", arrived=1.0, start=T0):
    """Lines of a price list: one message an hour."""
    return [json.dumps({"timestamp_ms": start + 3_600_000 * h, "price_eur_mwh": p, "unit": "Eur/MWh", "region": region, "ingested_at": arrived})
            for h, p in enumerate(prices)]


def land(folder, name, lines, when):
    """A file that appears at once, with a time, so that files are read in a known order."""
    part = folder.parent / f"{folder.name}-{name}.tmp"
    part.write_text("\n".join(lines) + "\n")
    os.utime(part, (1_700_000_000 + when, 1_700_000_000 + when))
    os.rename(part, folder / name)


def file_stream(spark, folder, one_by_one=True):
    reader = spark.readStream.format("text")
    return (reader.option("maxFilesPerTrigger", 1) if one_by_one else reader).load(str(folder))


def week(spark, mean, std):
    """A baseline of the zone in all cells."""
    cells = [("DE_LU", m, d, h, float(mean), float(std)) for m in (11,) for d in range(1, 8) for h in range(24)]
    return spark.createDataFrame(cells, BASELINES_SCHEMA)


def test_scores_follow_a_published_baseline(spark, tmp_path):
    src, root, out = tmp_path / "in", str(tmp_path / "baselines"), str(tmp_path / "out")
    src.mkdir()
    assert lookup.publish(week(spark, 50, 10), root) == 1
    query = scoring.start_scoring(file_stream(spark, src), root, out, str(tmp_path / "ck"), trigger={"processingTime": "0 seconds"})[0]
    try:
        land(src, "a.txt", published([80.5]), 1)
        query.processAllAvailable()
        assert lookup.publish(week(spark, 80, 10), root) == 2
        (tmp_path / "baselines" / "version=3").mkdir()          # a publication that failed midway is not read
        land(src, "b.txt", published([80.5]), 2)
        query.processAllAvailable()
    finally:
        query.stop()
    rows = lake.read_realtime(spark, out).collect()
    assert sorted((r["expected_price"], r["anomaly_level"]) for r in rows) == [(50.0, "CRITICAL"), (80.0, "NORMAL")]
    assert lookup.publish(week(spark, 1, 1), root) == 4


def test_no_published_baseline_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="no version"):
        lookup.Refreshed(str(tmp_path / "none")).current(spark)


def test_source_is_read_once_and_a_failed_batch_leaves_rows_once(spark, tmp_path, monkeypatch):
    src, out, dead = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "dead")
    src.mkdir()
    land(src, "a.txt", published([50.0, 60.0]) + ["garbage"], 1)
    land(src, "b.txt", published([70.0]) + ["more garbage", "{}"], 2)
    whole, calls = scoring.write_batch, []

    def breaks_once(df, root, batch_id):
        calls.append((root, batch_id))
        if root == dead and batch_id == 1 and calls.count((root, batch_id)) == 1:
            raise OSError("disk gone")
        whole(df, root, batch_id)

    monkeypatch.setattr(scoring, "write_batch", breaks_once)
    start = lambda: scoring.start_scoring(file_stream(spark, src), week(spark, 50, 10), out, str(tmp_path / "ck"),
                                          trigger={"availableNow": True}, dead_letter_path=dead)
    queries = start()
    assert len(queries) == 1
    with pytest.raises(Exception, match="disk gone"):
        queries[0].awaitTermination(120)
    again = start()[0]
    again.awaitTermination(120)
    assert sum(p["numInputRows"] for p in again.recentProgress) == 3          # the batch that failed, read once for both outputs
    assert calls.count((out, 1)) == 2 and calls.count((out, 0)) == 1
    assert sorted(r["price_eur_mwh"] for r in lake.read_realtime(spark, out).collect()) == [50.0, 60.0, 70.0]
    bad = batches.read_batches(spark, dead, "value string").collect()
    assert sorted(r["value"] for r in bad) == ["garbage", "more garbage", "{}"]


def test_corrected_price_gives_one_more_row(spark, tmp_path):
    corrections.use_state_store(spark)
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    day = [40.0 + h for h in range(24)]
    changed = [*day[:7], 99.0, *day[8:]]
    land(src, "1.txt", published(day, arrived=1000.0), 1)
    land(src, "2.txt", published(day, arrived=1060.0), 2)                     # the same list again
    land(src, "3.txt", published(changed, arrived=1120.0), 3)                 # one price is corrected
    land(src, "4.txt", published(day, arrived=1030.0), 4)                     # an older list that comes late
    land(src, "5.txt", published(changed, arrived=1180.0) + ["garbage", "garbage"], 5)
    query = scoring.start_scoring(file_stream(spark, src), week(spark, 50, 10), out, str(tmp_path / "ck"), trigger={"availableNow": True},
                                  dedupe="latest", dead_letter_path=str(tmp_path / "dead"))[0]
    query.awaitTermination(600)
    rows = lake.read_realtime(spark, out).collect()
    assert len(rows) == 25
    hour = [r["price_eur_mwh"] for r in rows if r["event_time"] == dt.datetime(2024, 11, 13, 5, 13, 20)]
    assert sorted(hour) == [47.0, 99.0]
    assert batches.read_batches(spark, str(tmp_path / "dead"), "value string").count() == 2


def test_corrections_to_null_and_lists_in_one_batch(spark, tmp_path):
    corrections.use_state_store(spark)
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    lines = published([1.0], arrived=30.0) + published([2.0], arrived=10.0) + published([None], arrived=40.0) + published([None], arrived=50.0)
    land(src, "1.txt", lines, 1)
    scoring.start_scoring(file_stream(spark, src), week(spark, 50, 10), out, str(tmp_path / "ck"), trigger={"availableNow": True},
                          dedupe="latest")[0].awaitTermination(300)
    assert {r["price_eur_mwh"] for r in lake.read_realtime(spark, out).collect()} == {2.0, 1.0, None}


def test_compaction_keeps_rows_and_readers(spark, tmp_path):
    root, schema = str(tmp_path / "t"), "k long"
    for b in range(5):
        batches.write_batch(spark.range(b * 10, b * 10 + 10).toDF("k").repartition(3), root, b)
    before = batches.read_batches(spark, root, schema)                        # a reader that has listed its files
    assert len(before.inputFiles()) == 15
    (tmp_path / "t" / "batch_id=6").mkdir()                                   # still being written
    assert batches.compact(spark, root, schema, files=1) == (0, 4)
    after = batches.read_batches(spark, root, schema)
    assert len(after.inputFiles()) == 1
    assert sorted(r["k"] for r in before.collect()) == sorted(r["k"] for r in after.collect()) == list(range(50))
    assert batches.vacuum(spark, root) == 5
    assert batches.compact(spark, root, schema) is None
    for b in (5, 6, 8):
        batches.write_batch(spark.range(b * 10, b * 10 + 10).toDF("k"), root, b)
    assert batches.compact(spark, root, schema) == (5, 6)                     # 7 may still come
    assert sorted(r["k"] for r in batches.read_batches(spark, root, schema).collect()) == [*range(70), *range(80, 90)]


def test_dense_lookup_equals_join(spark):
    import random
    random.seed(3)
    cells = [(z, m, d, h, random.random(), random.choice([None, 0.0, 1.0])) for z in ("DE_LU", "AT") for m in range(1, 13)
             for d in range(1, 8) for h in range(24) if random.random() < 0.7]
    base = spark.createDataFrame(cells, BASELINES_SCHEMA)
    rows = [(random.choice(["DE_LU", "AT", "XX", None]), random.choice([None, *range(1, 13)]), random.randint(1, 7), random.randint(0, 23), k) for k in range(3000)]
    rows = spark.createDataFrame(rows, "country_code string, month_of_year int, day_of_week int, hour_of_day int, k int")
    values = ["avg_price_baseline", "stddev_price_baseline"]
    for how in ("inner", "left"):
        dense, joined = (gold.with_cells(rows, base, values, zones, how) for zones in (2, None))
        assert sorted(map(str, dense.select(sorted(dense.columns)).collect())) == sorted(map(str, joined.select(sorted(dense.columns)).collect()))
    plan = gold.with_cells(rows, base, values, 2)._jdf.queryExecution().executedPlan().toString()
    assert "[country_code#" in plan and "month_of_year#" not in plan.split("BroadcastHashJoin")[1].split("]")[0]
    assert gold.with_cells(rows, base, values, 10**6).columns == gold.with_cells(rows, base, values, None).columns
    twice = base.union(base.select("country_code", "month_of_year", "day_of_week", "hour_of_day", (base.avg_price_baseline + 1), "stddev_price_baseline"))
    with pytest.raises(Exception, match="DUPLICATED_MAP_KEY"):
        gold.with_cells(rows, twice, values, 2).collect()
