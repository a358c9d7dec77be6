"""Benchmark decontamination by winnowing.

A text is a sequence of words. Of each window of ``w`` neighbouring k-grams the least hash (the last of equal ones)
is kept as a fingerprint; which one is kept depends on the window alone. So any run of ``k + w - 1`` words that a
document shares with an item has a fingerprint in both, at the same place of the run. Documents and items are joined
on fingerprints, and each hit is extended word by word to both sides; a run as long as an item window is a hit.

An item of ``WINDOW`` words or more has windows of that length; a shorter one is one window. Each length that the
benchmark needs (13 at most) has its own ``k`` and ``w`` with ``k + w - 1`` equal to it, so short items are found too.

At scale: documents are read once. A bit table of fixed size (``FILTER_BITS``), made from the benchmark's
fingerprints, drops most fingerprints before the join; it lets false ones through, never drops a true one. What is
left carries a few words of context, so that texts are neither shuffled nor compared twice. The join is Spark's own
on hashes; sides of measured small size are broadcast, hot keys are split by adaptive execution. A passage that many
documents share costs each of them a few rows.

Defined results: a null or empty text has no words, no hits and isn't contaminated; an item without words is never
found; a null item_id is listed as the empty text; repeated rows are judged each, repeated items listed each; with an
empty benchmark nothing is contaminated, an empty document table gives an empty result; other columns don't matter.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridlake.llm import _arrays as A
from gridlake.llm._session import documents, free_name, prepare, written

WINDOW = 13
#: A document is contaminated if at least one in so many of its words is hit.
LEAST_SHARE = 20
FILTER_BITS = 23

#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` after lower-casing A-Z: digits, letters, and all bytes of other characters.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, bool)
_IS_WORD[48:58] = _IS_WORD[65:91] = _IS_WORD[97:123] = _IS_WORD[128:] = True
_VALUES = A.BYTE_VALUE[_LOWER]

_FOUND = "array<struct<span:int,hash:long,pos:int,lead:int,words:array<string>>>"


def parameters(span: int) -> tuple[int, int]:
    """k and w for runs of ``span`` words: their sum is one more."""
    k = (span + 1) // 2
    return k, span - k + 1


def _fingerprints(values: np.ndarray, first: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the fingerprints for runs of ``span`` words; ``first`` has each text's first word."""
    k, w = parameters(span)
    grams = A.window_hashes(values, k)
    place = A.window_minima(grams, w)
    place = np.unique(place[A.whole_windows(first, len(place), span)])
    return place, A.mix(grams[place] + A.U64(span))


def _scan(spans: list[int], table: np.ndarray | None, item_side: bool):
    """Per text: its number of words, and the fingerprints that the table lets through, with context."""
    def run(batches):
        for rows, data, offsets in A.text_blocks(batches, "text"):
            starts, ends, first = A.runs(_IS_WORD, data, offsets)
            values = A.word_hashes(data, starts, ends, _VALUES)
            n_words = np.diff(first)
            found: list[list] = [[] for _ in range(len(rows))]
            lower = _LOWER[data].tobytes() if spans else b""
            for span in spans:
                place, hashes = _fingerprints(values, first, span)
                if table is not None:
                    slot = hashes >> A.U64(64 - FILTER_BITS)
                    kept = (table[slot >> A.U64(3)] >> (slot & A.U64(7)).astype(np.uint8)) & 1 == 1
                    place, hashes = place[kept], hashes[kept]
                text = np.searchsorted(first, place, "right") - 1
                if item_side:
                    # a shorter item is one window; longer ones have windows of the full length only
                    ok = (n_words[text] == span) | (span == WINDOW) & (n_words[text] >= span)
                    place, hashes, text = place[ok], hashes[ok], text[ok]
                k = parameters(span)[0]
                for p, h, t in zip(place.tolist(), hashes.view(np.int64).tolist(), text.tolist()):
                    lo, hi = max(int(first[t]), p - (span - k)), min(int(first[t + 1]), p + span)
                    words = [lower[starts[i] : ends[i]].decode("utf-8", "replace") for i in range(lo, hi)]
                    found[t].append({"span": span, "hash": h, "pos": p - int(first[t]), "lead": p - lo, "words": words})
            yield pa.RecordBatch.from_arrays([rows.column("row"), pa.array(n_words, pa.int64()), pa.array(found, _arrow_found())], ["row", "n_words", "found"])
    return run


def _arrow_found() -> pa.DataType:
    return pa.list_(pa.struct([("span", pa.int32()), ("hash", pa.int64()), ("pos", pa.int32()), ("lead", pa.int32()), ("words", pa.list_(pa.string()))]))


def _lengths(items: DataFrame, text: str) -> list[int]:
    """Lengths of item windows that occur: ``WINDOW`` values at most."""
    counted = items.select(F.lit(0).cast("long").alias("row"), F.col(text).cast("string").alias("text")).mapInArrow(_scan([], None, True), f"row long, n_words long, found {_FOUND}")
    return [r[0] for r in counted.select(F.least("n_words", F.lit(WINDOW)).cast("int").alias("n")).filter("n > 0").distinct().orderBy("n").collect()]


def _bits(fingerprints: DataFrame) -> np.ndarray:
    """The bit table: words of 64 bits by Spark, ``2 ** (FILTER_BITS - 6)`` rows at most."""
    slots = fingerprints.select(F.shiftrightunsigned("hash", 64 - FILTER_BITS).alias("slot"))
    words = slots.groupBy(F.expr("shiftright(slot, 6)").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(slot & 63 AS int)))").alias("bits"))
    table = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    for word, bits in words.collect():
        table[word] = bits
    return table.view(np.uint8)


def _common(a: str, b: str):
    """How many words at the start of two arrays agree."""
    same = F.zip_with(F.col(a), F.col(b), lambda x, y: x.eqNullSafe(y))
    at = F.array_position(same, False)
    return F.when(at == 0, F.size(same)).otherwise(at - 1).cast("int")


def find(docs: DataFrame, text: str, items: DataFrame, item_id: str, item_text: str, keys: list[str]) -> DataFrame:
    """Per row of ``docs``: ``keys``, n_words, n_hit, n_items, items_sha256, contaminated."""
    spark = prepare(docs.sparkSession)
    spans = _lengths(items, item_text)
    schema = f"row long, n_words long, found {_FOUND}"
    numbered = items.select(F.monotonically_increasing_id().alias("row"), F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), F.col(item_text).cast("string").alias("text"))
    numbered = written(numbered, "items")  # the row numbers must not change
    item_marks = written(
        numbered.select("row", "text").mapInArrow(_scan(spans, None, True), schema)
        .select(F.col("row").alias("item_row"), F.explode("found").alias("f")).select("item_row", "f.*"), "item-fingerprints")
    table = spark.sparkContext.broadcast(_bits(item_marks))

    def scan_docs(batches):
        yield from _scan(spans, table.value, False)(batches)

    numbered_docs = docs.select(*[F.col(k).alias(f"key_{i}") for i, k in enumerate(keys)], F.col(text).cast("string").alias("text"))
    key_cols = [f"key_{i}" for i in range(len(keys))]
    # the document's keys ride along in one struct through the scan
    packed = numbered_docs.select(F.struct(*key_cols).alias("row"), "text")
    key_type = packed.schema["row"].dataType.simpleString()
    scanned = packed.mapInArrow(scan_docs, f"row {key_type}, n_words long, found {_FOUND}")
    scanned = written(scanned.select(F.monotonically_increasing_id().alias("id"), "row.*", "n_words", "found"), "document-words")

    marks = scanned.filter(F.size("found") > 0).select("id", F.explode("found").alias("f")).select("id", "f.*")
    hits = marks.alias("d").join(item_marks.alias("b"), ["span", "hash"]).select(
        "id", "b.item_row", "span", "d.pos",
        F.reverse(F.slice("d.words", F.lit(1), F.col("d.lead"))).alias("dl"), F.reverse(F.slice("b.words", F.lit(1), F.col("b.lead"))).alias("bl"),
        F.slice("d.words", F.col("d.lead") + 1, F.size("d.words")).alias("dr"), F.slice("b.words", F.col("b.lead") + 1, F.size("b.words")).alias("br"))
    hits = hits.select("id", "item_row", "span", "pos", _common("dl", "bl").alias("left"), _common("dr", "br").alias("right"))
    hits = hits.filter(F.col("left") + F.col("right") >= F.col("span")).select("id", "item_row", (F.col("pos") - F.col("left")).alias("lo"), (F.col("pos") + F.col("right")).alias("hi"))
    hits = written(hits, "hits")

    earlier = Window.partitionBy("id").orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1)
    spans_hit = hits.select("id", "lo", "hi").distinct().withColumn("from", F.greatest("lo", F.coalesce(F.max("hi").over(earlier), F.lit(0))))
    n_hit = spans_hit.groupBy("id").agg(F.sum(F.greatest(F.col("hi") - F.col("from"), F.lit(0))).cast("long").alias("n_hit"))
    named = hits.select("id", F.col("item_row").alias("row")).distinct().join(numbered.select("row", "item"), "row")
    by_items = named.groupBy("id").agg(F.count(F.lit(1)).alias("n_items"), F.array_join(F.array_sort(F.collect_list("item")), ",").alias("items"))
    out = scanned.drop("found").join(n_hit.join(by_items, "id"), "id", "left").fillna({"n_hit": 0, "n_items": 0, "items": ""})
    return out.select(
        *[F.col(c).alias(k) for c, k in zip(key_cols, keys)], "n_words", "n_hit", "n_items", F.sha2("items", 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (LEAST_SHARE * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


def clean(docs: DataFrame, text: str, items: DataFrame, item_id: str, item_text: str) -> DataFrame:
    """Rows of ``docs`` that aren't contaminated. Contamination depends on the text alone, so texts are told by a digest."""
    digest = F.sha2(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), 256)
    marked = docs.select(digest.alias("digest"), F.col(f"`{text}`").alias("text"))
    bad = written(find(marked, "text", items, item_id, item_text, ["digest"]).filter("contaminated").select("digest").distinct(), "contaminated")
    name = free_name(docs, "digest")
    bad = bad.withColumnRenamed("digest", name)
    return docs.join(bad, digest == bad[name], "left_anti")


def op2_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Contamination of each document by the items of ``benchmark``."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return find(documents(spark, sf_dir), "text", items, "item_id", "text", ["doc_id"])
