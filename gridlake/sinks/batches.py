"""A table that micro-batches append to: one folder a batch, packed into larger segments later.

``write_batch`` replaces the folder of its batch id, so a batch that is run again after a failure leaves the same rows
once. A folder counts when Spark's committer has finished it. ``compact`` packs complete batches that no segment covers
into a new segment ``_segments/FIRST-LAST``; from then on readers take the segment instead of its batches. The folders of
packed batches stay until ``vacuum``, so that readers that have listed them go on.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridlake.sources.files import Folder, committed

_BATCH, _SEGMENTS = "batch_id=", "_segments"
SEGMENT_BYTES = 128 << 20


def write_batch(df: DataFrame, root: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{root.rstrip('/')}/{_BATCH}{batch_id}")


def _listed(folder: Folder) -> tuple[list[tuple[int, int]], list[int]]:
    """Complete segments as (first, last) and complete batches, ascending."""
    segments = [tuple(map(int, n.split("-"))) for n in folder.folders(_SEGMENTS) if committed(folder, _SEGMENTS, n)]
    batches = [int(n[len(_BATCH):]) for n in folder.folders() if n.startswith(_BATCH) and committed(folder, n)]
    return sorted(segments), sorted(batches)


def _open(segments: list[tuple[int, int]], batches: list[int]) -> list[int]:
    """Batches that no segment covers."""
    return [b for b in batches if not any(lo <= b <= hi for lo, hi in segments)]


def _name(segment: tuple[int, int]) -> str:
    return f"{segment[0]}-{segment[1]}"


def read_batches(spark: SparkSession, root: str, schema) -> DataFrame:
    """All rows of complete batches, from segments where there are some; no rows before the first batch."""
    folder = Folder(spark, root)
    segments, batches = _listed(folder)
    paths = [folder.at(_SEGMENTS, _name(s)) for s in segments] + [folder.at(f"{_BATCH}{b}") for b in _open(segments, batches)]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def compact(spark: SparkSession, root: str, schema, least: int = 2, files: int | None = None) -> tuple[int, int] | None:
    """Pack the complete batches since the last segment into one segment, if there are ``least`` of them.

    ``files`` is the number of files of the segment; without it adaptive execution decides by size. Batches are packed up
    to the first gap, since a batch that is missing may still be running. Returns (first, last) or None.
    """
    folder = Folder(spark, root)
    segments, batches = _listed(folder)
    left = _open(segments, batches)
    run = [b for k, b in enumerate(left) if b == left[0] + k]
    if len(run) < least:
        return None
    rows = spark.read.schema(schema).parquet(*[folder.at(f"{_BATCH}{b}") for b in run])
    packed = rows.coalesce(files) if files else rows.hint("rebalance")
    packed.write.mode("overwrite").parquet(folder.at(_SEGMENTS, _name((run[0], run[-1]))))
    return run[0], run[-1]


def vacuum(spark: SparkSession, root: str) -> int:
    """Delete the folders of batches that a segment covers; call it when no reader of before the compaction is left."""
    folder = Folder(spark, root)
    segments, batches = _listed(folder)
    gone = sorted(set(batches) - set(_open(segments, batches)))
    for batch in gone:
        folder.delete(f"{_BATCH}{batch}")
    return len(gone)
