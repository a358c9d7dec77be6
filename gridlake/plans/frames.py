"""Lazily derived layer frames over one set of input tables.

``Frames(spark, sf_dir)`` builds bronze -> silver -> gold from the driver's tables through
the adapter, memoising each lazy DataFrame so one query plan references each layer once
(Spark then reuses identical exchanges inside that plan). Nothing here triggers a job or
writes a table, except ``date_bounds``, one global min/max that sizes the hour spine.
"""
from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from gridlake.operators import gold, silver
from gridlake.sources import driver_tables, seeds
from gridlake.sources.spine import spine_rows


class Frames:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return driver_tables.read_table(self.spark, self.sf_dir, name)

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")

    @cached_property
    def bronze(self) -> DataFrame:
        return driver_tables.bronze_from_events(self.events)

    @cached_property
    def wide(self) -> DataFrame:
        return silver.pivot_metrics(self.bronze)

    @cached_property
    def silver(self) -> DataFrame:
        return silver.features(self.wide)

    @cached_property
    def profile(self) -> DataFrame:
        return silver.price_profile(self.silver)

    @cached_property
    def stg_energy(self) -> DataFrame:
        return gold.stg_energy(self.silver)

    @cached_property
    def stg_price_stats(self) -> DataFrame:
        return gold.stg_price_stats(self.profile)

    @cached_property
    def dim_country(self) -> DataFrame:
        return gold.dim_country(self.spark)

    @cached_property
    def date_bounds(self) -> tuple[dt.datetime, dt.datetime]:
        # the hours of silver: those of bronze rows with a metric that silver keeps
        return gold.span_bounds(self.spark, self.bronze.where(silver.metric_group("metric_name") != "other"))

    @property
    def zones(self) -> int:
        """How many zones there are: the adapter's list bounds them."""
        return len(driver_tables.ZONES)

    @cached_property
    def month_rows(self) -> int:
        start, end = self.date_bounds
        return self.zones * ((end.year - start.year) * 12 + end.month - start.month + 1)

    @cached_property
    def dim_date(self) -> DataFrame:
        start, end = self.date_bounds
        return gold.dim_date(self.spark, start, end)

    @cached_property
    def fct_energy_hourly(self) -> DataFrame:
        start, end = self.date_bounds
        return gold.fct_energy_hourly(
            self.stg_energy, self.dim_country, self.dim_date,
            countries_rows=seeds.COUNTRY_SEED_ROWS, dates_rows=spine_rows(start, end),
        )

    @cached_property
    def fct_price_baselines(self) -> DataFrame:
        return gold.fct_price_baselines(self.stg_price_stats, self.dim_country)
