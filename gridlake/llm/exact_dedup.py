"""Exact deduplication by counting quotient filters: fingerprints are counted in filters, repeated ones are verified by bytes.

Texts are equal when they agree after each run of blanks became one space. A text's fingerprint is ``FINGERPRINT_BITS``
bits of a hash. Each partition builds counting quotient filters of its fingerprints: the high bits of a fingerprint
name a segment, the next ones (the quotient) a run of slots, and the slots hold the low ones (the remainders), ascending
in each run; a remainder that occurs more than once is followed by slots with the digits of its count. A filter spells
its fingerprints exactly, so the filters of a segment merge without loss: their remainders are merged in order and the
counts of equal ones added. Fingerprints whose merged count is above one are routed to byte verification: the
normalised texts themselves are grouped, so that fingerprints that agree by chance come apart again. All other rows
are alone and never move.

At scale: the filters of a partition hold a hot text once, so what is shuffled is a few bytes for each distinct
fingerprint of a partition, and a segment has some ``SEGMENT`` fingerprints however large the corpus is. Texts move
for repeated fingerprints only, one copy a task (grouping is partial before the shuffle). The list of repeated
fingerprints is broadcast up to ``BROADCAST_ROWS`` rows (8 MB of numbers); beyond that it is joined by shuffles that
adaptive execution splits where a key is hot. Rows take part in the last joins by digest, not by text.

Defined results: a null text counts as empty, so null and empty texts are equal, and differ from a text of blanks
alone; of equal rows the one with the least key stays (null last; of those that tie, the one read first); repeated rows
are copies; whole texts are read; an empty table gives an empty result; carried columns may have any name.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.llm._session import documents, free_name, prepare, written

FINGERPRINT_BITS = 64
#: Fingerprints of a merged filter, on average.
SEGMENT = 1 << 18
#: Repeated fingerprints that are broadcast, at most.
BROADCAST_ROWS = 1 << 20
BLANKS = r"[\x20\x09-\x0D]+"

U64 = np.uint64
_HEAD = 3  # 64-bit numbers before the bits of a filter: quotient bits, remainder bits, slots


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), BLANKS, " ")


def _counted(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, ascending, and the sums of their counts."""
    order = np.argsort(values, kind="stable")
    values, counts = values[order], counts[order]
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    at = np.flatnonzero(new)
    return values[at], np.add.reduceat(counts, at) if len(at) else counts


def build(values: np.ndarray, counts: np.ndarray, bits: int) -> bytes:
    """A counting quotient filter of distinct ascending fingerprints of ``bits`` bits and their counts."""
    n = len(values)
    q = max(1, min(bits - 1, int(n - 1).bit_length()))
    r = bits - q
    quotient, remainder = (values >> U64(r)).astype(np.int64), values & U64((1 << r) - 1)
    # the digits of count - 1 in base 2 ** r: none for single fingerprints, and at most as many as 63 bits need
    over, digits = (counts - 1).astype(U64), []
    while over.any():
        digits.append(np.where(over > 0, over & U64((1 << r) - 1), 0).astype(U64))
        over = over >> U64(r)
    n_digits = np.zeros(n, np.int64)
    for k, _ in enumerate(digits):
        n_digits[(counts - 1).astype(U64) >> U64(r * k) > 0] = k + 1
    start = np.cumsum(n_digits + 1) - n_digits - 1
    n_slots = int((n_digits + 1).sum())
    slots, is_digit, last = np.zeros(n_slots, U64), np.zeros(n_slots, bool), np.zeros(n_slots, bool)
    slots[start] = remainder
    for k, digit in enumerate(digits):
        own = n_digits > k
        slots[start[own] + k + 1], is_digit[start[own] + k + 1] = digit[own], True
    ends = np.ones(n, bool)
    ends[:-1] = quotient[1:] != quotient[:-1]
    last[(start + n_digits)[ends]] = True
    occupied = np.zeros(1 << q, bool)
    occupied[quotient] = True
    wide = np.ascontiguousarray(slots.view(np.uint8).reshape(n_slots, 8)[:, : (r + 7) // 8])
    head = np.array([q, r, n_slots], np.int64)
    return b"".join([head.tobytes(), np.packbits(occupied).tobytes(), np.packbits(last).tobytes(), np.packbits(is_digit).tobytes(), wide.tobytes()])


def spell(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The fingerprints of a filter, ascending, and their counts."""
    q, r, n_slots = (int(x) for x in np.frombuffer(data, np.int64, _HEAD))
    at = 8 * _HEAD

    def bits(n: int) -> np.ndarray:
        nonlocal at
        out = np.unpackbits(np.frombuffer(data, np.uint8, (n + 7) // 8, at))[:n].astype(bool)
        at += (n + 7) // 8
        return out

    occupied, last, is_digit = bits(1 << q), bits(n_slots), bits(n_slots)
    width = (r + 7) // 8
    slots = np.zeros((n_slots, 8), np.uint8)
    slots[:, :width] = np.frombuffer(data, np.uint8, n_slots * width, at).reshape(n_slots, width)
    slots = slots.view(U64).ravel()
    run = np.cumsum(last) - last
    quotient = np.flatnonzero(occupied)[run].astype(U64)
    first = np.flatnonzero(~is_digit)
    entry = np.cumsum(~is_digit) - 1
    counts = np.ones(len(first), np.int64)
    digit = np.flatnonzero(is_digit)
    np.add.at(counts, entry[digit], (slots[digit] << ((digit - first[entry[digit]] - 1) * r).astype(U64)).astype(np.int64))
    return quotient[first] << U64(r) | slots[first], counts


def _filters(bits: int, high: int):
    """Of a partition: a filter for each segment (the ``high`` first bits of a fingerprint) that occurs."""
    def run(batches):
        values, counts = np.empty(0, U64), np.empty(0, np.int64)
        held, size = [], 0

        def fold():
            own = np.concatenate([values, *held])
            return _counted(own, np.concatenate([counts, np.ones(size, np.int64)]))

        for batch in batches:
            held.append(batch.column("fp").to_numpy().view(U64))
            size += len(batch)
            if size > max(1 << 16, len(values)):
                values, counts = fold()
                held, size = [], 0
        values, counts = fold()
        low = bits - high
        edges = np.searchsorted(values, np.arange(1, 1 << high, dtype=U64) << U64(low)) if high else np.empty(0, np.int64)
        cuts = np.concatenate([[0], edges, [len(values)]])
        full = np.flatnonzero(np.diff(cuts))
        for lo in range(0, len(full), 64):
            some = full[lo : lo + 64]
            made = [build(values[cuts[s] : cuts[s + 1]] & U64((1 << low) - 1), counts[cuts[s] : cuts[s + 1]], low) for s in some.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(made, pa.binary())], ["segment", "filter"])
    return run


def _merged(bits: int):
    def run(key, group):
        """The filters of a segment as one: remainders in order, counts of equal ones added."""
        parts = [spell(f.as_py()) for f in group.column("filter")]
        values, counts = _counted(np.concatenate([v for v, _ in parts]), np.concatenate([c for _, c in parts]))
        return pa.table({"segment": pa.array([key[0].as_py()], pa.int64()), "filter": pa.array([build(values, counts, bits)], pa.binary())})
    return run


def _repeated(low: int):
    def run(batches):
        for batch in batches:
            for segment, data in zip(batch.column("segment").to_pylist(), batch.column("filter")):
                values, counts = spell(data.as_py())
                often = counts > 1
                found = (values[often] | U64((segment << low) & (1 << 64) - 1)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(counts[often], pa.int64())], ["fp", "n"])
    return run


def filters(prints: DataFrame, bits: int = FINGERPRINT_BITS, segment: int = SEGMENT) -> tuple[DataFrame, int]:
    """A written table (segment, filter) that counts the column ``fp`` of ``prints``, and the bits that name a segment."""
    high = min(bits - 2, max(0, int(prints.count() - 1).bit_length() - (segment.bit_length() - 1)))
    made = prints.select("fp").mapInArrow(_filters(bits, high), "segment long, filter binary")
    return written(made.groupBy("segment").applyInArrow(_merged(bits - high), "segment long, filter binary"), "filters"), high


def repeated(merged: DataFrame, high: int, bits: int = FINGERPRINT_BITS) -> DataFrame:
    """(fp, n) of the fingerprints that a filter counts more than once."""
    return merged.mapInArrow(_repeated(bits - high), "fp long, n long")


def groups(docs: DataFrame, key: str, text: str, carry: list[str] = (), bits: int = FINGERPRINT_BITS, segment: int = SEGMENT,
           broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Per row of ``docs``: c0, c1 ... (``carry``), key, keep_key, group_size, kept, sha (of the normalised text)."""
    prepare(docs.sparkSession)
    # a fingerprint is a number of ``bits`` bits; with 64 it may be negative as a long
    print_of = F.shiftrightunsigned(F.xxhash64("norm"), 64 - bits) if bits < 64 else F.xxhash64("norm")
    texts = docs.select(F.col(f"`{key}`").alias("key"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)], normalised(F.col(f"`{text}`")).alias("norm"))
    carried = [f"c{i}" for i in range(len(carry))]
    prints = written(texts.select(F.monotonically_increasing_id().alias("id"), "key", *carried, print_of.alias("fp"), F.sha2("norm", 256).alias("sha")), "prints")
    merged, high = filters(prints, bits, segment)
    often = written(repeated(merged, high, bits).select("fp"), "repeated")
    if often.count() <= broadcast_rows:
        often = F.broadcast(often)

    # byte verification: texts are grouped as they are, one copy a task is shuffled
    same = texts.select("norm", print_of.alias("fp")).join(often, "fp", "left_semi").groupBy("fp", "norm").agg(F.count(F.lit(1)).alias("n"))
    same = same.filter("n > 1").select("fp", F.sha2("norm", 256).alias("sha"), "n")
    # rows are told by digests from here on; texts of one digest would be told apart, and end the run
    verified = same.groupBy("fp", "sha").agg(F.sum("n").alias("group_size"), F.count(F.lit(1)).alias("texts"))
    one = F.when(F.col("texts") == 1, F.col("group_size")).otherwise(F.raise_error(F.lit("unequal texts share a sha256 digest")).cast("long"))
    verified = verified.select("fp", "sha", one.alias("group_size"))
    rows = prints.join(often, "fp", "left_semi").groupBy("fp", "sha").agg(F.min(F.struct(F.col("key").isNull().alias("without"), "key", "id")).alias("first"))
    found = written(verified.join(rows, ["fp", "sha"]).select("fp", "sha", "group_size", F.col("first.key").alias("first_key"), F.col("first.id").alias("first_id")), "equal")
    out = prints.join(found, ["fp", "sha"], "left")
    alone = F.col("first_id").isNull()
    return out.select(
        *carried, "key", F.when(alone, F.col("key")).otherwise(F.col("first_key")).alias("keep_key"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"), (alone | (F.col("id") == F.col("first_id"))).alias("kept"), "sha")


def dedup(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Rows of ``docs`` without those whose text equals that of another row with a lesser key, or an earlier row."""
    name = free_name(docs, "row")
    held = written(docs.withColumn(name, F.monotonically_increasing_id()), "documents")
    # only rows of repeated texts can go, so only their numbers are joined
    gone = groups(held, key, text, [name]).filter("not kept").select(F.col("c0").alias(name))
    return held.join(gone, name, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def oracle() -> str:
    """The same in DuckDB."""
    return r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
FROM t"""


def op11_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """Per document: doc_id, keep_id, group_size, kept, text_sha256."""
    found = groups(documents(spark, sf_dir), "doc_id", "text")
    return found.select(F.col("key").alias("doc_id"), F.col("keep_key").alias("keep_id"), "group_size", "kept", F.col("sha").alias("text_sha256"))
