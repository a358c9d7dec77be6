"""Documents in blocks: rows of a table that hold some MB of text each, packed, in a fixed order.

A block is a unit of work that stays the same however often it is read, so a later pass can name a window by its
place in its block. Blocks are written once to the shared folder; a task holds one block at a time.
"""
from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm import _arrays as A
from gridlake.llm._session import prepare, written

#: Bytes of text in a block, unless one text has more. A bucket of hashes gets about as many as a block has; for
#: tens of TB, larger blocks keep the number of (block, bucket) pairs low.
BLOCK_BYTES = 8 << 20
_CODEC = "zstd"


def pack(table: pa.Table) -> bytes:
    out = io.BytesIO()
    with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression=_CODEC)) as writer:
        writer.write_table(table)
    return out.getvalue()


def unpack(data: bytes) -> pa.Table:
    with pa.ipc.open_stream(pa.py_buffer(data)) as reader:
        return reader.read_all()


def pack_numbers(values: np.ndarray) -> bytes:
    """Ascending 64-bit numbers: differences, by bytes of equal weight, compressed."""
    steps = np.diff(values, prepend=values[:1] - values[:1])
    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T)
    return pa.compress(planes.tobytes(), codec=_CODEC, asbytes=True)


def unpack_numbers(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 8 * n, codec=_CODEC), np.uint8).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel())


def blocks(docs: DataFrame, order: str, text: str, carry: list[str], limit: int = BLOCK_BYTES, marks=None) -> DataFrame:
    """A written table (block, n_texts, payload, marks). A payload has the columns order, text, c0, c1 ... by order, then
    text; a null order comes first (as the least long), a null text is empty. ``marks`` makes bytes from a payload."""
    prepare(docs.sparkSession)
    picked = docs.select(F.coalesce(F.col(order).cast("long"), F.lit(-(1 << 63))).alias("order"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
                         *[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)])

    def run(batches):
        part, number, held, size = TaskContext.get().partitionId(), 0, [], 0

        def block():
            table = pa.Table.from_batches(held).combine_chunks()
            table = table.take(pc.sort_indices(table, [("order", "ascending"), ("text", "ascending")]))
            return pa.RecordBatch.from_arrays([pa.array([(part << 33) | number], pa.int64()), pa.array([len(table)], pa.int32()), pa.array([pack(table)], pa.binary()), pa.array([marks(table) if marks else None], pa.binary())], ["block", "n_texts", "payload", "marks"])

        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            at = 0
            ends = np.cumsum(sizes)
            while at < len(batch):
                room = limit - size + (ends[at - 1] if at else 0)
                to = int(np.searchsorted(ends, room, "right"))
                if to <= at and not held:
                    to = at + 1
                if to > at:
                    held.append(batch.slice(at, to - at))
                    size += int(sizes[at:to].sum())
                    at = to
                if at < len(batch) or size >= limit:
                    yield block()
                    held, size, number = [], 0, number + 1
        if held:
            yield block()

    return written(picked.mapInArrow(run, "block long, n_texts int, payload binary, marks binary"), "blocks")


def bucket_bits(n_blocks: int) -> int:
    """Bits that name a bucket of hashes: about as many buckets as blocks, 2 ** 16 at most."""
    return int(min(16, max(3, np.ceil(np.log2(max(1, n_blocks))))))


def sub_blocks(table: pa.Table):
    """Ranges of a block's texts that are worked on at once: first text, bytes, offsets."""
    data, offsets = A.utf8(table.column("text"))
    for lo, hi in A.blocks(offsets):
        yield lo, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
