"""A lookup in versions: each publication is a new folder, readers take the last one that is complete.

A version is never changed once it is published, so a batch that has begun with one ends with it, and a batch that is
run again can be told which version it had. A reader asks for the last version before each micro-batch (one listing)
and reads the table only when it has changed.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridlake.sources.files import Folder, committed

_PREFIX = "version="


def versions(spark: SparkSession, root: str) -> list[int]:
    """Complete versions, ascending."""
    folder = Folder(spark, root)
    found = [n for n in folder.folders() if n.startswith(_PREFIX) and n[len(_PREFIX):].isdigit() and committed(folder, n)]
    return sorted(int(n[len(_PREFIX):]) for n in found)


def publish(df: DataFrame, root: str) -> int:
    """Write ``df`` as the next version and return its number. Versions that failed midway are never read."""
    folder = Folder(df.sparkSession, root)
    taken = [int(n[len(_PREFIX):]) for n in folder.folders() if n.startswith(_PREFIX) and n[len(_PREFIX):].isdigit()]
    version = max(taken, default=0) + 1
    df.write.mode("errorifexists").parquet(folder.at(f"{_PREFIX}{version}"))
    return version


def read_version(spark: SparkSession, root: str, version: int) -> DataFrame:
    return spark.read.parquet(Folder(spark, root).at(f"{_PREFIX}{version}"))


def _zones(kept: DataFrame) -> int:
    return kept.select("country_code").distinct().count()


class Refreshed:
    """The rows of the last version, kept in memory until there is a newer one, and the number of their zones."""

    def __init__(self, root: str):
        self.root = root
        self.version: int | None = None
        self.zones = 0
        self._kept: DataFrame | None = None

    def current(self, spark: SparkSession) -> DataFrame:
        found = versions(spark, self.root)
        if not found:
            raise FileNotFoundError(f"no version of the lookup is published in {self.root}")
        if found[-1] != self.version:
            kept = read_version(spark, self.root, found[-1]).persist()
            self.zones = _zones(kept)
            if self._kept is not None:
                self._kept.unpersist()
            self._kept, self.version = kept, found[-1]
        return self._kept


class Fixed:
    """The same for a frame that doesn't change."""

    def __init__(self, df: DataFrame):
        self._kept = df.persist()
        self.zones = _zones(self._kept)

    def current(self, spark: SparkSession) -> DataFrame:
        return self._kept
