"""Price baselines kept up to date month by month (E2, E7): a stored table of mergeable moments.

A cell's price statistics are its count, its mean and M2, the sum of squared distances from the mean. The moments of
parts add up to those of the whole, so a baseline over all years is a merge of small rows and never reads the history
again. ``moments`` computes them for new rows (partial aggregation; a hot zone is summed where it lies), ``update``
stores them by (year, month) and replaces only the months that the new rows belong to, and ``profile`` and
``month_hour`` merge what is stored. A zone has at most 168 stored rows a month.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CELL = ["country", "month", "weekday", "hour"]
STORED = "country string, weekday int, hour int, day int, n long, mean double, m2 double, year int, month int"


def moments(silver: DataFrame, by_day: bool = False) -> DataFrame:
    """(country, weekday, hour, day, n, mean, m2, year, month) of the prices of silver rows; ``day`` is 0 unless ``by_day``.

    A cell without prices has n = 0 and no mean, so that it is in the baseline as it would be in a full rebuild.
    """
    price = F.col("price").cast("double")
    day = F.col("day").cast("int") if by_day else F.lit(0)
    return (
        silver.groupBy("country", "year", "month", day.alias("day"), "weekday", "hour")
        .agg(F.count(price).alias("n"), F.avg(price).alias("mean"), (F.var_pop(price) * F.count(price)).alias("m2"))
        .select("country", F.col("weekday").cast("int").alias("weekday"), F.col("hour").cast("int").alias("hour"), "day", "n", "mean", "m2",
                F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month"))
    )


def update(new: DataFrame, root: str) -> None:
    """Store the moments of whole months; a month that is stored already is replaced, all others stay as they are."""
    parts = new.hint("rebalance", "year", "month").sortWithinPartitions("year", "month", "country", "weekday", "hour")
    parts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "month").parquet(root)


def stored(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(STORED).option("basePath", root).parquet(root)


def _step(acc: Column, part: Column) -> Column:
    """Moments of two parts together; the means' distance is used, not sums of squares, which would cancel."""
    n = acc["n"] + part["n"]
    apart = part["mean"] - acc["mean"]
    share = F.try_divide(part["n"].cast("double"), n.cast("double"))
    both = F.struct(n.alias("n"), (acc["mean"] + apart * share).alias("mean"), (acc["m2"] + part["m2"] + apart * apart * acc["n"] * share).alias("m2"))
    return F.when(part["n"] == 0, acc).when(acc["n"] == 0, part).otherwise(both)


def merged(parts: DataFrame, keys: list[str | Column]) -> DataFrame:
    """One row of moments for each value of ``keys``. A key gathers one row for each part (year, or month and weekday)."""
    row = F.struct("year", "month", "day", "weekday", F.struct("n", "mean", "m2").alias("m"))
    listed = parts.groupBy(*keys).agg(F.array_sort(F.collect_list(row)).alias("parts"))
    rows = F.transform("parts", lambda p: p["m"])
    total = F.aggregate(F.slice(rows, F.lit(2), F.size(rows)), F.element_at(rows, 1), _step)
    return listed.withColumn("m", total).drop("parts").select("*", "m.n", "m.mean", "m.m2").drop("m")


def _std() -> Column:
    """Sample standard deviation, NULL for fewer than two prices."""
    return F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1)))


def profile(parts: DataFrame) -> DataFrame:
    """The price profile (E2), as ``silver.price_profile`` makes it from all rows."""
    return merged(parts, CELL).select(*CELL, F.col("mean").alias("avg_price_baseline"), _std().alias("stddev_price_baseline"), F.col("n").alias("sample_size"))


def month_hour(parts: DataFrame, factor: float = 1.0) -> DataFrame:
    """The month-hour baseline (E7), as ``gold.month_hour_baseline`` makes it; rows without a zone are left out."""
    found = merged(parts.where(F.col("country").isNotNull()), ["country", "month", "hour"])
    return found.select(F.col("country").alias("country_code"), "month", "hour", (F.col("mean") * F.lit(factor)).alias("hist_mean"), (_std() * F.lit(factor)).alias("hist_std"))
