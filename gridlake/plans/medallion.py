"""The batch flow: wide CSV -> bronze -> silver -> gold, each layer written as a table.

Each layer is read back from what was written, so every stage starts from a short lineage
(a lost executor never sends the job back to the CSV) and downstream reads get partition
pruning on the layer's layout. Paths are arguments (R8); the session is passed in (R13).
"""
from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Observation, SparkSession

from gridlake import schemas
from gridlake.operators import bronze as bronze_ops
from gridlake.operators import gold, quality, silver
from gridlake.sinks import writers
from gridlake.sources import lake, seeds, wide_csv
from gridlake.sources.spine import spine_rows


@dataclass(frozen=True)
class LakePaths:
    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze/entsoe"

    @property
    def features(self) -> str:
        return f"{self.root}/silver/features"

    @property
    def profile(self) -> str:
        return f"{self.root}/silver/stats/price_profile"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold"

    @property
    def realtime(self) -> str:
        return f"{self.root}/realtime/market_monitor"


def ingest(spark: SparkSession, csv_path: str, paths: LakePaths) -> tuple[list[str], int]:
    """Wide CSV -> bronze (C1–C9, B1): one file, or a folder of files with headers of their own (A1).

    Returns the zones of the headers and the number of cells that are text but no number (S4): bronze has them as
    missing. They are counted while bronze is written, so the files are scanned once.
    """
    seen = Observation()
    if wide_csv.is_folder(spark, csv_path):
        wides = wide_csv.read_wide_all(spark, csv_path)
    else:
        wide = wide_csv.read_wide(spark, csv_path)
        wides = [(wide_csv.discover_zones(wide.columns), wide)]
    writers.write_bronze(bronze_ops.to_long_all(wides, seen), paths.bronze)
    return sorted({z for zones, _ in wides for z in zones}), seen.get["unparsable_cells"]


def build_silver(spark: SparkSession, paths: LakePaths, **feature_options) -> None:
    """Bronze -> silver features and price profile.

    The profile is computed from the written features, not from the feature plan, so the
    windows run once for both outputs.
    """
    bronze = lake.read_bronze(spark, paths.bronze)
    writers.write_silver_features(silver.features(silver.pivot_metrics(bronze), **feature_options), paths.features)
    features = lake.read_silver_features(spark, paths.features)
    writers.write_price_profile(silver.price_profile(features), paths.profile)


def build_gold(spark: SparkSession, paths: LakePaths, start: dt.datetime | None = None,
               end: dt.datetime | None = None, zones: int | None = None, seed_dir: str | None = None) -> None:
    """Silver -> staging -> dimensions, facts, marts.

    The hour spine spans the data unless bounds are given (R6). ``zones``, the number of zones, bounds the baselines.
    ``seed_dir`` has the seeds as CSV files (A5); without it they come from ``schemas``.
    """
    features = lake.read_silver_features(spark, paths.features)
    profile = lake.read_price_profile(spark, paths.profile)
    stg = gold.stg_energy(features)
    if start is None or end is None:
        lo, hi = gold.span_bounds(spark, features.select("timestamp"))
        start, end = start or lo, end or hi
    country_seed = metric_seed = None
    if seed_dir is not None:
        country_seed = seeds.read_seed_csv(spark, f"{seed_dir}/country_iso_map.csv", schemas.COUNTRY_SEED)
        metric_seed = seeds.read_seed_csv(spark, f"{seed_dir}/energy_metrics.csv", schemas.METRIC_SEED)
    countries = gold.dim_country(spark, country_seed)
    dates = gold.dim_date(spark, start, end)
    months = None if zones is None else zones * ((end.year - start.year) * 12 + end.month - start.month + 1)
    country_rows = seeds.COUNTRY_SEED_ROWS if seed_dir is None else None
    write = lambda df, name, by=None: writers.write_gold(df, paths.gold, name, by)
    write(countries, "dim_country")
    write(gold.dim_energy_metrics(spark, metric_seed), "dim_energy_metrics")
    write(dates, "dim_date")
    write(gold.fct_energy_hourly(stg, countries, dates, country_rows, spine_rows(start, end)),
          "fct_energy_hourly", ["year"])
    write(gold.fct_price_baselines(gold.stg_price_stats(profile), countries, countries_rows=country_rows), "fct_price_baselines")
    fact = lake.read_gold(spark, paths.gold, "fct_energy_hourly")
    baselines = lake.read_gold(spark, paths.gold, "fct_price_baselines")
    write(gold.green_performance(fact), "mrt_country_green_performance")
    write(gold.financial_risk(fact, months), "mrt_financial_risk")
    write(gold.duck_curve(fact), "mrt_duck_curve_monthly")
    write(gold.price_anomaly(fact, baselines, zones=zones), "mrt_price_anomaly_detection")


def check_gold(spark: SparkSession, paths: LakePaths, target_zones: list[str] | None = None):
    """Run the data-quality suite (F1–F10) over the written layers; returns the report frame."""
    g = lambda name: lake.read_gold(spark, paths.gold, name)
    bronze = lake.read_bronze(spark, paths.bronze)
    fact, countries, metrics, dates = (g(t) for t in ("fct_energy_hourly", "dim_country", "dim_energy_metrics", "dim_date"))
    stg = gold.stg_energy(lake.read_silver_features(spark, paths.features))
    stats = gold.stg_price_stats(lake.read_price_profile(spark, paths.profile))
    checks = [
        quality.key_by_part(stg, "stg_energy", "energy_event_id", "country_code", "event_time", ["year"], {"price_eur_mwh": "warn"}),
        quality.not_null(stats, "stg_price_stats", ["country_code"]),
        quality.key(countries, "dim_country", "country_code"),
        quality.key(dates, "dim_date", "time_key"),
        quality.key(metrics, "dim_energy_metrics", "metric_code"),
        quality.key_by_part(fact, "fct_energy_hourly", "energy_event_id", "country_code", "event_time", ["year"]),
        quality.not_null(g("fct_price_baselines"), "fct_price_baselines", ["country_code", "avg_price_baseline"]),
        quality.not_null(g("mrt_price_anomaly_detection"), "mrt_price_anomaly_detection", ["price_z_score"], "warn"),
        quality.relationship(fact, "fct_energy_hourly", "country_code", countries, "country_code",
                             parent_rows=seeds.COUNTRY_SEED_ROWS),
        quality.columns_present(spark, bronze, "bronze"),
        quality.bronze_checks(bronze, "bronze", target_zones),
    ]
    return quality.report(checks)


def run(spark: SparkSession, csv_path: str, root: str, seed_dir: str | None = None, gate: bool = True, **feature_options):
    """CSV -> bronze -> silver -> gold -> checks. Returns the quality report, written as ``quality_report``.

    With ``gate``, a failed check of severity ``error`` fails the run (``quality.QualityError``), after the report
    is written.
    """
    paths = LakePaths(root.rstrip("/"))
    zones, unparsable = ingest(spark, csv_path, paths)
    build_silver(spark, paths, **feature_options)
    build_gold(spark, paths, zones=len(zones), seed_dir=seed_dir)
    report = quality.report([check_gold(spark, paths, zones), quality.counted(spark, "unparsable_cells", "wide", unparsable)])
    writers.write_report(report, f"{paths.root}/quality_report")
    written = spark.read.parquet(f"{paths.root}/quality_report")
    return quality.gate(written) if gate else written
