import datetime as dt
import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from gridlake import schemas
from gridlake.operators import quality
from gridlake.plans import catalog, medallion
from gridlake.sources import lake

SF = "/root/testdata/sf0.001"


def test_batch_flow_end_to_end(spark, tmp_path, write_csv):
    header = ["utc_timestamp", "DE_LU_price_day_ahead", "DE_LU_load_actual_entsoe_transparency",
              "DE_LU_solar_generation_actual", "DE_LU_wind_generation_actual", "SE_1_price_day_ahead",
              "SE_1_load_actual_entsoe_transparency"]
    rows = []
    for i in range(72):
        ts = dt.datetime(2020, 1, 1) + dt.timedelta(hours=i)
        rows.append([ts.strftime("%Y-%m-%dT%H:%M:%SZ"), str(30 + i % 7), str(50000 + 10 * i), "NA",
                     str(100 + i), str(20 + i % 3), str(8000 + i)])
    rows[5][4] = "n.a."          # text that is neither a number nor a NULL token
    path = write_csv(tmp_path, "wide.csv", header, rows)
    seeds = tmp_path / "seeds"
    seeds.mkdir()
    write_csv(seeds, "country_iso_map.csv", ["code", "country_name", "eu_region"], schemas_rows(schemas.COUNTRY_ROWS))
    write_csv(seeds, "energy_metrics.csv", [f.name for f in schemas.METRIC_SEED], schemas_rows(schemas.METRIC_ROWS))
    report = medallion.run(spark, path, str(tmp_path / "lake"), seed_dir=str(seeds)).collect()
    by = {(r["check"], r["table"], r["column"]): r for r in report}
    assert by[("unique", "fct_energy_hourly", "energy_event_id")]["passed"]
    assert by[("relationships", "fct_energy_hourly", "country_code")]["failing_rows"] == 0
    assert by[("min_rows", "bronze", None)]["passed"] is False           # a warning, far below 1M rows
    assert by[("unparsable_cells", "wide", None)]["failing_rows"] == 1
    assert by[("not_null", "stg_price_stats", "country_code")]["passed"]
    paths = medallion.LakePaths(str(tmp_path / "lake"))
    fact = lake.read_gold(spark, paths.gold, "fct_energy_hourly")
    assert fact.count() == 144 and fact.where("year IS NULL").count() == 0
    green = lake.read_gold(spark, paths.gold, "mrt_country_green_performance").collect()
    assert sum(r["hours_in_bucket"] for r in green) == 144


def test_failed_check_fails_the_flow(spark, tmp_path, write_csv):
    header = ["utc_timestamp", "DE_LU_price_day_ahead", "ZZ_price_day_ahead"]        # no such zone in the seed
    path = write_csv(tmp_path, "wide.csv", header, [["2020-01-01T00:00:00Z", "30", "31"]])
    with pytest.raises(quality.QualityError, match="relationships fct_energy_hourly.country_code: 1"):
        medallion.run(spark, path, str(tmp_path / "lake"))
    assert spark.read.parquet(str(tmp_path / "lake" / "quality_report")).count() > 20
    assert medallion.run(spark, path, str(tmp_path / "lake"), gate=False).where("not passed").count() > 0


def test_streams_need_a_shared_folder(spark):
    from gridlake.session import checkpoint_root
    if spark.sparkContext.getConf().get("spark.checkpoint.dir", None) is None:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            checkpoint_root(spark)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:5] == ["country_name", "year", "month", "penetration_bucket", "bucket_sort_order"]
    assert df.count() > 0


def schemas_rows(rows):
    return [["" if v is None else str(v).lower() if isinstance(v, bool) else str(v) for v in r] for r in rows]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ["region", "nation", "events"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    rel = duck.sql(catalog.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    order_s = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    order_o = sorted(range(len(rel.columns)), key=lambda i: rel.columns[i])
    a = Counter(tuple(_norm(r[i]) for i in order_s) for r in df.collect())
    b = Counter(tuple(_norm(r[i]) for i in order_o) for r in rel.fetchall())
    assert a == b
