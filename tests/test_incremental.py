"""Stored baselines, keys by part, files of unlike headers, a bronze write that fails midway."""
import datetime as dt
import os
import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from gridlake.operators import baselines, bronze, gold, quality, silver
from gridlake.plans import medallion
from gridlake.sinks import writers
from gridlake.sources import lake, wide_csv
from gridlake.sources.files import Folder


def hours(spark, start, n, seed, base=1e6):
    """Silver rows of two zones with large prices that differ little, where sums of squares would lose all digits."""
    random.seed(seed)
    rows = [(start + dt.timedelta(hours=h), z, None if random.random() < 0.1 else base + random.random()) for h in range(n) for z in ("AT", "SE_1")]
    return silver.calendar(spark.createDataFrame(rows, "timestamp timestamp_ntz, country string, price double"))


def rows_of(df, keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def same(got, want, keys, digits=1e-12):
    got, want = rows_of(got, keys), rows_of(want, keys)
    assert got.keys() == want.keys()
    for k, w in want.items():
        for c, x in w.asDict().items():
            y = got[k][c]
            assert (x is None) == (y is None), (k, c, x, y)
            if isinstance(x, float):
                # the prices' own digits: sigma of 1e6 + u is known to about 1e-10 by either way
                assert abs(x - y) <= max(digits * abs(x), 2e-9 if "std" in c else 0), (k, c, x, y)
            elif x is not None:
                assert x == y


def test_monthly_moments_equal_a_rebuild(spark, tmp_path):
    root = str(tmp_path / "moments")
    jan, feb, other = (hours(spark, dt.datetime(y, m, 1), n, seed) for y, m, n, seed in ((2020, 1, 744, 1), (2020, 2, 500, 2), (2021, 1, 744, 3)))
    for part in (jan, feb, other):
        baselines.update(baselines.moments(part), root)
    kept = {p: p.stat().st_mtime_ns for p in (tmp_path / "moments" / "year=2020" / "month=1").glob("*.parquet")}
    feb = hours(spark, dt.datetime(2020, 2, 1), 696, 4)                       # the month again, now whole and with other prices
    baselines.update(baselines.moments(feb), root)
    whole = jan.union(feb).union(other)
    stored = baselines.stored(spark, root)
    same(baselines.profile(stored), silver.price_profile(whole), baselines.CELL)
    fact = whole.select(F.col("country").alias("country_code"), F.col("timestamp").alias("event_time"), F.col("price").alias("price_eur_mwh"))
    same(baselines.month_hour(stored, 3.0), gold.month_hour_baseline(fact, 3.0), ["country_code", "month", "hour"])
    assert kept == {p: p.stat().st_mtime_ns for p in (tmp_path / "moments" / "year=2020" / "month=1").glob("*.parquet")}


def test_merge_of_days_small_cells_and_no_prices(spark):
    rows = [(dt.datetime(2020, 1, d, h), z, p) for d, h, z, p in [(6, 1, "AT", 5.0), (13, 1, "AT", None), (20, 1, "AT", 7.0), (6, 2, "AT", None), (7, 3, "AT", 4.0), (7, 3, None, 9.0)]]
    frame = silver.calendar(spark.createDataFrame(rows, "timestamp timestamp_ntz, country string, price double"))
    same(baselines.profile(baselines.moments(frame, by_day=True)), silver.price_profile(frame), baselines.CELL)
    empty = frame.where("false")
    assert baselines.profile(baselines.moments(empty)).count() == 0


def test_key_by_part(spark):
    start = dt.datetime(2019, 12, 31, 20)
    rows = [(z, start + dt.timedelta(hours=h)) for h in range(40_000) for z in ("AT", "SE_1")]
    frame = spark.createDataFrame(rows, "country_code string, event_time timestamp_ntz").withColumn("year", F.year("event_time"))
    frame = frame.withColumn("id", F.md5(F.concat("country_code", F.col("event_time").cast("string")))).repartition(5)
    check = lambda df: {r["check"]: r["failing_rows"] for r in quality.key_by_part(df, "t", "id", "country_code", "event_time", ["year"]).collect()}
    assert check(frame) == {"unique": 0, "not_null": 0}
    more = frame.union(frame.where("event_time = '2021-03-04 05:00:00'")).union(frame.limit(1).withColumn("event_time", F.lit(dt.datetime(2030, 1, 1, 0, 30)).cast("timestamp_ntz")))
    nulls = more.union(frame.limit(1).withColumn("country_code", F.lit(None).cast("string")).withColumn("id", F.lit(None).cast("string")))
    assert check(nulls) == {"unique": 3, "not_null": 1}
    assert check(frame.where("false")) == {"unique": 0, "not_null": 0}
    plan = quality.key_by_part(frame, "t", "id", "country_code", "event_time", ["year"])._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and not any("id#" in line.split("hashpartitioning")[1] or "event_time" in line for line in exchanges)


HEADERS = [["utc_timestamp", "AT_price_day_ahead", "AT_load_actual", "SE_1_price_day_ahead"],
           ["SE_1_price_day_ahead", "utc_timestamp", "AT_load_actual", "AT_price_day_ahead"],      # permuted
           ["utc_timestamp", "SE_1_price_day_ahead", "AT_load_actual", "NO_2_price_day_ahead"],    # AT without a price: not a zone here
           ["utc_timestamp", "AT_price_day_ahead", "AT_load_actual", "SE_1_price_day_ahead"]]      # the first one again


def test_folder_of_unlike_headers_equals_its_files(spark, tmp_path, write_csv):
    folder = tmp_path / "wide"
    folder.mkdir()
    for k, header in enumerate(HEADERS):
        rows = [[f"2021-0{k + 1}-01T0{h}:00:00Z" if c == "utc_timestamp" else str(10 * k + h + i / 8) for i, c in enumerate(header)] for h in range(3)]
        rows[1][header.index("AT_load_actual")] = "broken"
        write_csv(folder, f"{k}.csv", header, rows)
    (folder / "_notes.csv").write_text("hidden\n")
    wides = wide_csv.read_wide_all(spark, str(folder))
    assert [zones for zones, _ in wides] == [["AT", "SE_1"], ["AT", "SE_1"], ["NO_2", "SE_1"]]
    seen = Observation()
    got = sorted(map(tuple, bronze.to_long_all(wides, seen).collect()))
    want = sorted(tuple(r) for k in range(4) for r in bronze.to_long(wide_csv.read_wide(spark, str(folder / f"{k}.csv"))).collect())
    assert got == want and len(got) == 3 * 9 - 3 + 6
    assert seen.get == {"cells": 3 * 9 + 6, "unparsable_cells": 3}
    (tmp_path / "none").mkdir()
    with pytest.raises(ValueError, match="No price columns"):
        wide_csv.read_wide_all(spark, str(tmp_path / "none"))
    zones, unparsable = medallion.ingest(spark, str(folder), medallion.LakePaths(str(tmp_path / "lake")))
    assert zones == ["AT", "NO_2", "SE_1"] and unparsable == 3
    assert lake.read_bronze(spark, str(tmp_path / "lake" / "bronze" / "entsoe")).count() == len(got)


def test_compressed_files_and_first_lines(spark, tmp_path):
    import gzip
    with gzip.open(tmp_path / "a.csv.gz", "wt") as out:
        out.write("utc_timestamp,AT_price_day_ahead\n2021-01-01T00:00:00Z,4\n")
    assert Folder(spark, str(tmp_path)).first_line(str(tmp_path / "a.csv.gz")) == "utc_timestamp,AT_price_day_ahead"
    assert bronze.to_long_all(wide_csv.read_wide_all(spark, str(tmp_path), ".csv.gz")).count() == 1


def bronze_rows(spark, months, value):
    rows = [(None if m is None else dt.datetime(2020, m, 1 + d), "AT", "price_day_ahead", value, None if m is None else "2020", None if m is None else f"{m:02d}")
            for m in months for d in range(3)]
    return spark.createDataFrame(rows, "timestamp timestamp_ntz, country string, metric_name string, value double, year string, month string")


def test_failed_bronze_write_leaves_former_rows(spark, tmp_path):
    root = str(tmp_path / "bronze")
    writers.write_bronze(bronze_rows(spark, [1, 2, 3], 1.0), root)
    broken = bronze_rows(spark, [2, 3, 4], 2.0).withColumn("value", F.when(F.col("month") == "04", F.raise_error(F.lit("cut off")).cast("double")).otherwise(F.col("value")))
    with pytest.raises(Exception, match="cut off"):
        writers.write_bronze(broken, root)
    read = lambda: {(r["year"], r["month"], r["value"]): r["count"] for r in lake.read_bronze(spark, root).groupBy("year", "month", "value").count().collect()}
    assert read() == {(2020, m, 1.0): 3 for m in (1, 2, 3)}
    writers.write_bronze(bronze_rows(spark, [2, 3, 4, None], 2.0), root)       # the former month 1 isn't in the new rows
    assert read() == {**{(2020, m, 2.0): 3 for m in (2, 3, 4)}, (None, None, 2.0): 3}
    writers.write_bronze(bronze_rows(spark, [4], 3.0), root)
    assert read() == {(2020, 4, 3.0): 3}
    assert [n for n in os.listdir(root) if "staging" in n] == []
