import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridlake.operators import bronze
from gridlake.sources import wide_csv


def test_discover_zones_sorted_distinct():
    cols = ["utc_timestamp", "AT_price_day_ahead", "DE_LU_price_day_ahead", "DE_LU_load_actual", "AT_price_day_ahead"]
    assert wide_csv.discover_zones(cols) == ["AT", "DE_LU"]


def test_no_price_columns_raises(tmp_path, spark, write_csv):
    path = write_csv(tmp_path, "noprice.csv", ["utc_timestamp", "PL_wind_generation_actual", "BE_load_actual"],
                     [["2021-07-09T10:00:00Z", "3.5", "4"]])
    with pytest.raises(ValueError, match="No price columns"):
        wide_csv.read_wide(spark, path)


def test_wide_to_long_fixture(spark, wide_csv):
    long = bronze.to_long(wide_csv and wide_csv_frame(spark, wide_csv))
    rows = long.collect()
    assert len(rows) == 40
    assert all(r["value"] is not None for r in rows)
    assert long.columns == ["timestamp", "country", "metric_name", "value", "year", "month"]
    first = long.where((F.col("country") == "PL") & (F.col("metric_name") == "price_day_ahead")) \
        .orderBy("timestamp").first()
    assert first["timestamp"] == dt.datetime(2021, 7, 9, 10, 0)
    assert first["value"] == 4.05
    assert first["year"] == "2021" and first["month"] == "07"
    assert {r["country"] for r in rows} == {"PL", "DK_1", "BE"}


def wide_csv_frame(spark, path):
    return wide_csv.read_wide(spark, path)


def test_nested_prefixes_tokens_and_unparsable(tmp_path, spark, write_csv):
    header = ["utc_timestamp", "IT_NORD_price_day_ahead", "IT_NORD_AT_price_day_ahead", "IT_NORD_AT_load_actual",
              "SE_1_price_day_ahead", "SE_2_price_day_ahead", "XX_load_actual"]
    rows = [
        ["2020-03-01T05:00:00Z", "1.5", "NA", "7", "nan", "-", "9"],
        ["2020-03-01T06:00:00Z", "2.5", "3.5", "", "abc", "4", "9"],
    ]
    path = write_csv(tmp_path, "nested.csv", header, rows)
    wide = wide_csv.read_wide(spark, path)
    assert "XX_load_actual" not in wide.columns          # zone without a price column vanishes
    long = bronze.to_long(wide)
    got = sorted((r["country"], r["metric_name"], r["value"]) for r in long.collect())
    assert got == [
        ("IT_NORD", "price_day_ahead", 1.5),
        ("IT_NORD", "price_day_ahead", 2.5),
        ("IT_NORD_AT", "load_actual", 7.0),
        ("IT_NORD_AT", "price_day_ahead", 3.5),
        ("SE_2", "price_day_ahead", 4.0),
    ]
    bad = bronze.unparsable_cells(wide).first().asDict()
    assert bad["SE_1_price_day_ahead"] == 1 and sum(bad.values()) == 1
    assert {r["month"] for r in long.collect()} == {"03"}


def test_zone_pattern_longest_first():
    assert bronze.zone_pattern(["IT_NORD", "IT_NORD_AT", "AT"]) == "^(IT_NORD_AT|IT_NORD|AT)_"


def test_bronze_write_and_read_back(tmp_path, spark, wide_csv):
    from gridlake.sinks import writers
    from gridlake.sources import lake
    root = str(tmp_path / "bronze")
    writers.write_bronze(bronze.to_long(wide_csv_frame(spark, wide_csv)), root)
    back = lake.read_bronze(spark, root)
    assert back.count() == 40
    assert dict(back.dtypes)["year"] == "int" and dict(back.dtypes)["month"] == "int"
    # idempotent overwrite
    writers.write_bronze(bronze.to_long(wide_csv_frame(spark, wide_csv)), root)
    again = lake.read_bronze(spark, root)
    assert again.count() == 40
    assert again.where("year = 2021 AND month = 7").count() == 40
