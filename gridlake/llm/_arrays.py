"""Texts of an Arrow batch as arrays: bytes, words, rolling hashes. Used inside tasks, on a block of texts at a time."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at a time; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20
U64 = np.uint64
#: Odd multipliers of the rolling hashes of bytes and of words, and their inverses modulo 2 ** 64.
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits each depend on all input bits."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


BYTE_VALUE = mix(np.arange(1, 257, dtype=U64) * U64(BYTE_BASE))


class _Powers:
    """Powers of an odd base and of its inverse, as long as asked for."""

    def __init__(self, base: int):
        self.base, self.inverse = base & _MASK, pow(base, -1, 1 << 64)
        self.up = self.down = np.empty(0, U64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, BLOCK_BYTES + 1)

            def run(base: int) -> np.ndarray:
                out = np.full(size, base, U64)
                out[0] = 1
                return np.multiply.accumulate(out)

            self.up, self.down = run(self.base), run(self.inverse)
        return self.up[:n], self.down[:n]


_BYTE_POWERS, _WORD_POWERS = _Powers(BYTE_BASE), _Powers(WORD_BASE)


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and offsets (one more than texts). A null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if offsets else np.zeros(1, np.int64)
    text = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and len(column) else np.empty(0, np.uint8)
    return text, at - at[0]


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold ``limit`` bytes at most, or one text."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def text_blocks(batches: Iterator[pa.RecordBatch], name: str, limit: int = BLOCK_BYTES):
    """For each block of texts: the rows of the batch, the bytes, and the offsets (from 0)."""
    for batch in batches:
        data, offsets = utf8(batch.column(name))
        for lo, hi in blocks(offsets, limit):
            yield batch.slice(lo, hi - lo), data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]


def runs(is_word: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words: maximal runs of bytes that the table ``is_word`` holds. Starts, ends, and the first word of each text."""
    inside = is_word[data]
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    before, after = np.empty(len(data), bool), np.empty(len(data), bool)
    before[0], after[-1] = False, False
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before[edges], after[edges - 1] = False, False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = BYTE_VALUE) -> np.ndarray:
    """A 64-bit hash of each word; ``values`` maps a byte to its number (bytes with equal numbers count as equal)."""
    up, down = _BYTE_POWERS(len(data) + 1)
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum(values[data] * up[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64))


def window_hashes(values: np.ndarray, width: int) -> np.ndarray:
    """Rabin-Karp hashes of all windows of ``width`` neighbours, from running sums; as many as there are windows."""
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, U64)
    up, down = _WORD_POWERS(len(values) + 1)
    sums = np.zeros(len(values) + 1, U64)
    np.cumsum(values * up[:-1], out=sums[1:])
    return mix((sums[width:] - sums[:n]) * down[:n])


def byte_window_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """The same for windows of bytes."""
    n = len(data) - width + 1
    if n <= 0:
        return np.empty(0, U64)
    up, down = _BYTE_POWERS(len(data) + 1)
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum(BYTE_VALUE[data] * up[:-1], out=sums[1:])
    return mix((sums[width:] - sums[:n]) * down[:n])


def whole_windows(first: np.ndarray, n: int, width: int) -> np.ndarray:
    """Which of ``n`` windows (by their first element) lie in one text; ``first`` has each text's first element."""
    ok = np.ones(max(n, 0), bool)
    for edge in first[1:-1]:
        ok[max(0, edge - width + 1) : edge] = False
    return ok


def window_minima(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` neighbouring hashes, the place of the least one (the last of equal ones)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.int64)
    least, place = hashes[:n].copy(), np.arange(n)
    for j in range(1, width):
        other = hashes[j : j + n]
        lower = other <= least
        least = np.where(lower, other, least)
        place = np.where(lower, np.arange(j, j + n), place)
    return place
