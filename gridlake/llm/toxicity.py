"""Toxicity: a linear classifier of character n-grams whose features are scaled by naive Bayes log-count ratios.

Training uses a bounded sample of labelled rows (``SAMPLE`` documents with the least hashes of their text, each
distinct text once). Spark counts, by class, in how many sample documents each n-gram occurs: the sample is dealt into
``FOLDS`` groups by hash, a group counts the n-grams that at least two of its documents hold, and the groups' counts
are added. The ``FEATURES`` n-grams with the greatest likelihood-ratio statistics of their counts (``LEAST_STRENGTH``
at least) become features; a feature's value is its log-count ratio if the text holds the n-gram, else 0. A logistic regression with
an L2 penalty, fitted to the sample, gives the weights. All tables of the model have fixed bounds.

Scoring reads whole texts, whatever their length: each text's distinct features add their weights; the score is the
logistic function of the sum. It needs no shuffle. n-grams are known by 64-bit hashes of their characters.

Labels, language, source and identifiers are no inputs of a score; labels serve training alone.

Defined results: a null or empty text has the score of no features; repeated rows get equal scores; rows without a
label are scored but not learnt from; labels of a document given twice count once if they agree, and the greatest
counts if not; without labels of both classes the score is the share of label 1 (0 without any); an empty table gives
an empty result; only ``doc_id`` and ``text`` are read, so other columns can't clash.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm import _arrays as A
from gridlake.llm._session import documents, prepare, written

ORDERS = (3, 4, 5)
SAMPLE = 12_000
FOLDS = 4
LEAST_DOCS = 5
FEATURES = 6_000
LEAST_STRENGTH = 10.0
PENALTY = 1e-3
ROUNDS = 300
#: Rows whose crc32(doc_id as text) mod 4 is 2 are held out of training.
HELD_OUT = 2
THRESHOLD = 0.3
_BLOCK_CHARS = 1 << 19
_TABLE_BITS = 20


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


def _characters(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case characters of all texts, each between two zeros; and where each text begins (and the end)."""
    low = [(t or "").replace("\0", " ").lower() for t in texts]
    chars = np.frombuffer(("\0" + "\0".join(low) + "\0").encode("utf-32-le", "replace"), np.uint32).astype(A.U64)
    sizes = np.fromiter((len(t) + 1 for t in low), np.int64, len(low))
    return chars, np.concatenate([[0], np.cumsum(sizes)])


def _grams(chars: np.ndarray):
    """For each order, the hashes of the n-grams at each place; one that holds a zero spans two texts."""
    values = A.mix(chars + A.U64(1))
    rolled = values
    for n in range(2, max(ORDERS) + 1):
        rolled = rolled[:-1] * A.U64(A.BYTE_BASE) + values[n - 1 :]
        if n in ORDERS:
            yield n, A.mix(rolled)


def _chunks(texts: list[str | None]):
    """Ranges of texts with a bounded number of characters, or one text."""
    lo = size = 0
    for i, t in enumerate(texts):
        if i > lo and size + len(t or "") > _BLOCK_CHARS:
            yield lo, i
            lo, size = i, 0
        size += len(t or "")
    if lo < len(texts):
        yield lo, len(texts)


def _count(fold: pa.Table) -> pa.Table:
    """n-grams that at least two documents of a fold hold: numbers of documents of each class."""
    texts, labels = fold.column("text").to_pylist(), np.array(fold.column("label").to_pylist(), np.int64)
    keys, toxic, clean = np.empty(0, A.U64), np.empty(0, np.int64), np.empty(0, np.int64)
    for lo, hi in _chunks(texts):
        chars, at = _characters(texts[lo:hi])
        zero = np.concatenate([[0], np.cumsum(chars == 0)])
        found, label = [], []
        for n, hashes in _grams(chars):
            zeros = zero[n : len(hashes) + n] - zero[: len(hashes)]
            for d in range(hi - lo):
                # a zero at an end of an n-gram is the border of its text; with two it is a whole short text
                here = slice(at[d], max(at[d], at[d + 1] - n + 2))
                own = np.unique(hashes[here][zeros[here] <= 1])
                found.append(own)
                label.append(np.full(len(own), labels[lo + d]))
        both = np.concatenate([keys, *found])
        t = np.concatenate([toxic, *label])
        c = np.concatenate([clean, *[1 - x for x in label]])
        keys, back = np.unique(both, return_inverse=True)
        toxic = np.bincount(back, t, len(keys)).astype(np.int64)
        clean = np.bincount(back, c, len(keys)).astype(np.int64)
    kept = toxic + clean >= 2
    return pa.table({"gram": keys[kept].view(np.int64), "toxic": toxic[kept], "clean": clean[kept]})


class Model:
    """Sorted hashes of the features, their weights (ratios included), and the constant term."""

    def __init__(self, grams: np.ndarray, weights: np.ndarray, constant: float):
        order = np.argsort(grams)
        self.grams, self.weights, self.constant = grams[order], weights[order], constant
        self.table = np.zeros(1 << _TABLE_BITS, bool)
        self.table[(grams >> A.U64(64 - _TABLE_BITS)).astype(np.int64)] = True

    def present(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a text and a feature that it holds, each once."""
        if not len(self.grams):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        chars, at = _characters(texts)
        out = []
        for _, hashes in _grams(chars):
            place = np.flatnonzero(self.table[(hashes >> A.U64(64 - _TABLE_BITS)).astype(np.int64)])
            near = np.minimum(np.searchsorted(self.grams, hashes[place]), len(self.grams) - 1)
            hit = self.grams[near] == hashes[place]
            text = np.searchsorted(at, place[hit], "right") - 1
            out.append(np.minimum(text, len(texts) - 1) * len(self.grams) + near[hit])
        both = np.unique(np.concatenate(out))
        return both // len(self.grams), both % len(self.grams)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        out = np.full(len(texts), self.constant)
        for lo, hi in _chunks(texts):
            text, feature = self.present(texts[lo:hi])
            out[lo:hi] += np.bincount(text, self.weights[feature], hi - lo)
        return 1 / (1 + np.exp(-np.clip(out, -500, 500)))


def _fit(text: np.ndarray, feature: np.ndarray, ratios: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression on scaled features by gradient steps with adapted sizes (Adam)."""
    values = ratios[feature]
    n, m = len(labels), len(ratios)
    w, share = np.zeros(m + 1), labels.mean()
    w[m] = np.log(share / (1 - share))
    first, second = np.zeros(m + 1), np.zeros(m + 1)
    for k in range(1, ROUNDS + 1):
        z = np.bincount(text, values * w[feature], n) + w[m]
        off = 1 / (1 + np.exp(-np.clip(z, -500, 500))) - labels
        grad = np.append(np.bincount(feature, values * off[text], m) / n + PENALTY * w[:m], off.mean())
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad**2
        w -= 0.02 * (first / (1 - 0.9**k)) / (np.sqrt(second / (1 - 0.999**k)) + 1e-8)
    return w[:m] * ratios, float(w[m])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from rows of ``labels`` (doc_id, toxic) that are not held out."""
    prepare(docs.sparkSession)
    marks = labels.select("doc_id", F.col("toxic").cast("int").alias("label")).filter("doc_id is not null and label in (0, 1)").filter(~held_out(F.col("doc_id")))
    marks = marks.groupBy("doc_id").agg(F.max("label").alias("label"))
    # the least hashes first, so that the sample doesn't depend on how rows are dealt; no text is shuffled for it
    own = docs.select("doc_id", F.col("text").cast("string").alias("text")).filter("text is not null")
    hashed = own.select("doc_id", F.xxhash64("text").alias("h")).join(marks, "doc_id")
    picked = hashed.groupBy("h").agg(F.max_by("doc_id", F.struct("label", "doc_id")).alias("doc_id"), F.max("label").alias("label")).orderBy("h").limit(sample)
    data = written(own.join(F.broadcast(picked), "doc_id").filter(F.xxhash64("text") == F.col("h")).dropDuplicates(["h"]), "toxic-sample")
    counts = {r["label"]: r["count"] for r in data.groupBy("label").count().collect()}
    total, toxic = sum(counts.values()), counts.get(1, 0)
    if toxic in (0, total):
        share = toxic / total if total else 0.0
        return Model(np.empty(0, A.U64), np.empty(0), float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))))
    schema = "gram long, toxic long, clean long"
    counted = data.groupBy(F.pmod("h", F.lit(FOLDS)).alias("fold")).applyInArrow(_count, schema)
    summed = counted.groupBy("gram").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c")).filter(F.col("t") + F.col("c") >= LEAST_DOCS)
    ratio = F.log((F.col("t") + 0.5) / (toxic + 1.0)) - F.log((F.col("c") + 0.5) / (total - toxic + 1.0))
    both = F.col("t") + F.col("c")
    part = lambda seen, share: F.when(seen > 0, seen * F.log(seen / (both * share))).otherwise(0.0)
    strength = 2 * (part(F.col("t"), toxic / total) + part(F.col("c"), 1 - toxic / total))
    best = summed.select("gram", ratio.alias("r"), strength.alias("g")).filter(F.col("g") >= LEAST_STRENGTH).orderBy(F.desc("g"), "gram").limit(FEATURES).collect()
    grams = np.array([r["gram"] for r in best], np.int64).view(A.U64)
    ratios = np.array([r["r"] for r in best])
    finder = Model(grams, ratios, 0.0)
    grams, ratios = finder.grams, finder.weights
    shared = data.sparkSession.sparkContext.broadcast(finder)

    def features(batches):
        for batch in batches:
            texts, label = batch.column("text").to_pylist(), batch.column("label").to_pylist()
            for lo, hi in _chunks(texts):
                text, feature = shared.value.present(texts[lo:hi])
                parts = np.split(feature.astype(np.int32), np.searchsorted(text, np.arange(1, hi - lo)))
                yield pa.RecordBatch.from_arrays([pa.array([p.tobytes() for p in parts], pa.binary()), pa.array(label[lo:hi], pa.int32())], ["features", "label"])

    held = data.select("h", "text", "label").repartition(FOLDS, "h").sortWithinPartitions("h").select("text", "label").mapInArrow(features, "features binary, label int").collect()
    parts = [np.frombuffer(r["features"], np.int32) for r in held]
    text = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    weights, constant = _fit(text, np.concatenate(parts), ratios, np.array([r["label"] for r in held], float))
    return Model(grams, weights, constant)


def score(docs: DataFrame, model: Model, carry: list[str], name: str = "score") -> DataFrame:
    """``carry`` columns of ``docs`` and the score of each whole text, as ``name``."""
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    packed = docs.select(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)]).alias("row"), F.col("text").cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            scores = shared.value.scores(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(scores, pa.float64())], ["row", "score"])

    out = packed.mapInArrow(run, f"row {packed.schema['row'].dataType.simpleString()}, score double")
    return out.select(*[F.col("row")[f"c{i}"].alias(c) for i, c in enumerate(carry)], F.col("score").alias(name))


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    out = score(docs, model, ["doc_id"])
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
