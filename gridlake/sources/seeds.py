"""Seed tables (A5): zone map and metric catalogue.

They are built from the fixed rows in ``gridlake.schemas`` on the driver (32 and 5 rows), so
they work on any cluster without a shared file; ``read_seed_csv`` loads a seed kept on shared
storage instead.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridlake import schemas

COUNTRY_SEED_ROWS = len(schemas.COUNTRY_ROWS)
METRIC_SEED_ROWS = len(schemas.METRIC_ROWS)


def country_seed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(schemas.COUNTRY_ROWS, schemas.COUNTRY_SEED)


def metric_seed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(schemas.METRIC_ROWS, schemas.METRIC_SEED)


def read_seed_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)
