r"""Ranked lexical search: all items of a benchmark ranked over all documents, with common parts evaluated once.

Terms are runs of digits, letters and characters beyond ASCII, in ASCII lower case. A document's score for an item is the
sum, over the item's terms (repeats included), of an integer weight times a saturated, length-normalised frequency.

Multi-query common-subexpression evaluation, in three layers that share their parts:

1. *Atoms* are mined as maximal sets of terms that occur in the same items, as often in each. An atom's partial
   accumulator (the sum of its terms' scores, for the documents that hold one) is made once, whatever items use it.
2. *Shared sets* are mined as in a frequent-pattern tree: each item lists its atoms by the number of items that share
   them, so items with common frequent atoms begin alike. A node of the tree is such a beginning; its accumulator is its
   parent's plus one atom's, made once for all items below it. Atoms hang below many nodes, so parts form a graph
   without cycles: terms, atoms, nodes, items.
3. An item's scores are its last node's accumulator.

At scale: documents are read once. A bit table of fixed size made from the items' terms drops most words where they are
read; what is written is a document's length and its counts of likely terms. Document frequencies and the numbers of
documents and terms are sums over all of it. Items are evaluated in blocks of some ``BLOCK_TERMS`` terms: a block's graph
(some MB) goes to all tasks, each task evaluates it for a batch of documents at a time and holds ten documents for each
item, so ten rows an item and task are shuffled. More items mean more blocks, more documents more tasks. Terms are
compared by 64-bit hashes: with v terms in the items and d in the documents, v * d / 2 ** 64 false matches are expected.

Defined results: a null or empty text (or one without terms) has no terms, counts neither in N nor in a frequency, and is
never listed; an item without terms, or whose terms occur nowhere, has no rows; equal scores come by ascending key
(null last); repeated documents are listed each; repeated items are ranked each; whole texts are read; empty tables give
an empty result; other columns are left out and can't clash.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlake.llm import _arrays as A
from gridlake.llm._session import documents, prepare, written
from gridlake.llm.decontaminate import _IS_WORD, _VALUES
from gridlake.llm.near_dedup import weighted

TOP = 10
#: Terms of a block of items, on average, and bits (as a power of two) of the table of the items' terms.
BLOCK_TERMS = 1 << 18
FILTER_BITS = 23

_COUNTED = "n long, terms array<long>, counts array<long>"
_LISTED = pa.list_(pa.int64())


def _counts(table: np.ndarray | None):
    """Per text (column ``row`` rides along): the number of its terms, and the distinct ones that the table lets through."""
    def run(batches):
        for rows, data, offsets in A.text_blocks(batches, "text"):
            starts, ends, first = A.runs(_IS_WORD, data, offsets)
            hashes = A.word_hashes(data, starts, ends, _VALUES)
            text = np.repeat(np.arange(len(rows)), np.diff(first))
            if table is not None:
                slot = hashes >> A.U64(64 - FILTER_BITS)
                kept = (table[slot >> A.U64(3)] >> (slot & A.U64(7)).astype(np.uint8)) & 1 == 1
                text, hashes = text[kept], hashes[kept]
            text, hashes, counts = weighted(text, hashes)
            cuts = pa.array(np.searchsorted(text, np.arange(len(rows) + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(cuts, pa.array(x, pa.int64())) for x in (hashes.view(np.int64), counts.astype(np.int64))]
            yield pa.RecordBatch.from_arrays([rows.column("row"), pa.array(np.diff(first), pa.int64()), *lists], ["row", "n", "terms", "counts"])
    return run


def _bits(terms: DataFrame) -> np.ndarray:
    """The bit table of the column ``term``: words of 64 bits by Spark, ``2 ** (FILTER_BITS - 6)`` rows at most."""
    slots = terms.select(F.shiftrightunsigned("term", 64 - FILTER_BITS).alias("slot"))
    words = slots.groupBy(F.expr("shiftright(slot, 6)").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(slot & 63 AS int)))").alias("bits"))
    table = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    for word, bits in words.collect():
        table[word] = bits
    return table.view(np.uint8)


def weight(n: int, df: Column) -> Column:
    """floor(1000 ln((2 N + 2) / (2 df + 1))), in doubles."""
    return F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * n + 2.0) / (F.lit(2.0) * df + F.lit(1.0)))).cast("long")


def _tree(batches):
    """For each item, its beginnings: node, parent, the atom that is added and how often; the item at the last one."""
    for batch in batches:
        out: list[tuple] = []
        for item, path in zip(batch.column("item").to_pylist(), batch.column("path").to_pylist()):
            parent = 0
            for depth, step in enumerate(path):
                both = A.mix(np.array([parent, step["atom"] ^ (step["q"] * 0x9E3779B97F4A7C15 & (1 << 63) - 1)], np.int64).view(A.U64))
                node = int(A.mix(both[:1] + both[1:] * A.U64(3))[0].view(np.int64))
                out.append((node, parent, step["atom"], step["q"], depth, item if depth == len(path) - 1 else None))
                parent = node
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
        names = [x.split()[0] for x in _NODES.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 6, kinds)], names)


_NODES = "node long, parent long, atom long, q long, depth int, item long"


def query_graph(item_terms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For (item, term, q, w), w a positive weight: atoms as (atom, term, w) and the nodes of the tree as (node, parent,
    atom, q, depth, n_items, items), one row each; a node that several items pass has ``n_items`` above one."""
    used = item_terms.groupBy("term").agg(F.max("w").alias("w"), F.sort_array(F.collect_list(F.struct("item", "q"))).alias("used"))
    marked = used.withColumn("atom", F.xxhash64("used"))
    atoms = marked.select("atom", "term", "w")
    edges = marked.groupBy("atom").agg(F.first("used").alias("used")).select("atom", F.size("used").alias("shared"), F.explode("used").alias("u"))
    step = F.struct((-F.col("shared")).alias("order"), "atom", F.col("u.q").alias("q"))
    paths = edges.groupBy(F.col("u.item").alias("item")).agg(F.sort_array(F.collect_list(step)).alias("path"))
    walked = paths.mapInArrow(_tree, _NODES)
    nodes = walked.groupBy("node").agg(F.first("parent").alias("parent"), F.first("atom").alias("atom"), F.first("q").alias("q"), F.first("depth").alias("depth"),
                                       F.count(F.lit(1)).alias("n_items"), F.collect_list("item").alias("items"))
    return atoms, nodes


class Graph:
    """A block's graph as arrays: terms by hash, atoms by number, nodes in the order of a walk (parents first)."""

    def __init__(self, atoms: pa.Table, nodes: pa.Table):
        atoms = atoms.sort_by("term")
        self.terms, self.weights = atoms.column("term").to_numpy(), atoms.column("w").to_numpy()
        names, self.atom = np.unique(atoms.column("atom").to_numpy(), return_inverse=True)
        self.n_atoms = len(names)
        below: dict[int, list[int]] = {}
        parents, ids = nodes.column("parent").to_pylist(), nodes.column("node").to_pylist()
        for k, parent in enumerate(parents):
            below.setdefault(parent, []).append(k)
        order, stack = [], [*below.get(0, [])]
        while stack:
            k = stack.pop()
            order.append(k)
            stack += below.get(ids[k], [])
        nodes = nodes.take(pa.array(order, pa.int64()))
        self.node_atom = np.searchsorted(names, nodes.column("atom").to_numpy())
        self.q, self.depth, self.items = nodes.column("q").to_pylist(), nodes.column("depth").to_pylist(), nodes.column("items").to_pylist()


class _Best:
    """The best documents of an item so far: by score, then key, null last."""

    def __init__(self):
        self.score, self.key, self.without = (np.empty(0, np.int64) for _ in range(3))

    def meet(self, scores: np.ndarray, keys: np.ndarray, without: np.ndarray) -> None:
        least = max(1, int(self.score[-1])) if len(self.score) == TOP else 1
        new = np.flatnonzero(scores >= least)
        if len(new):
            score, key, null = np.concatenate([self.score, scores[new]]), np.concatenate([self.key, keys[new]]), np.concatenate([self.without, without[new]])
            order = np.lexsort((key, null, -score))[:TOP]
            self.score, self.key, self.without = score[order], key[order], null[order]


def _evaluate(graph, n_docs: int, n_terms: int):
    def run(batches):
        g: Graph = graph.value
        best: dict[int, _Best] = {}
        for batch in batches:
            size = len(batch)
            key, n = batch.column("key"), batch.column("n").to_numpy()
            without = key.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
            keys = key.fill_null(0).to_numpy()
            terms, counts = batch.column("terms"), batch.column("counts")
            doc = np.repeat(np.arange(size), np.diff(terms.offsets.to_numpy()))
            found, tf = terms.flatten().to_numpy(), counts.flatten().to_numpy()
            at = np.minimum(np.searchsorted(g.terms, found), max(len(g.terms) - 1, 0))
            known = g.terms[at] == found if len(g.terms) else np.zeros(len(found), bool)
            doc, tf, at = doc[known], tf[known], at[known]
            m = 25 + (75 * n * n_docs) // n_terms
            value = g.weights[at] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
            # partial accumulators of atoms, once: their documents and sums
            slot = g.atom[at] * size + doc
            slots, where = np.unique(slot, return_inverse=True)
            sums = np.zeros(len(slots), np.int64)
            np.add.at(sums, where, value)
            docs, cuts = slots % max(size, 1), np.searchsorted(slots, np.arange(g.n_atoms + 1) * size)
            stack = [np.zeros(size, np.int64)]
            for atom, q, depth, items in zip(g.node_atom.tolist(), g.q, g.depth, g.items):
                del stack[depth + 1 :]
                own = stack[depth]
                lo, hi = cuts[atom], cuts[atom + 1]
                if lo < hi:
                    own = own.copy()
                    own[docs[lo:hi]] += q * sums[lo:hi]
                stack.append(own)
                for item in items:
                    best.setdefault(item, _Best()).meet(own, keys, without)
        for item, b in best.items():
            if len(b.score):
                ids = pa.array(b.key, pa.int64(), mask=b.without.astype(bool))
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(b.score), pa.int64()), ids, pa.array(b.score, pa.int64())], ["item", "key", "score"])
    return run


def search(docs: DataFrame, key: str, text: str, items: DataFrame, item_id: str, item_text: str, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """For each row of ``items``: item_id, rank, key (an integer), score of its ``TOP`` best rows of ``docs``."""
    spark = prepare(docs.sparkSession)
    named = written(items.select(F.monotonically_increasing_id().alias("item"), F.col(f"`{item_id}`").alias("item_id"), F.col(f"`{item_text}`").cast("string").alias("text")), "items")
    item_terms = named.select(F.col("item").alias("row"), "text").mapInArrow(_counts(None), f"row long, {_COUNTED}")
    pairs = item_terms.select(F.col("row").alias("item"), F.explode(F.arrays_zip("terms", "counts")).alias("t"))
    pairs = written(pairs.select("item", F.col("t.terms").alias("term"), F.col("t.counts").alias("q")), "item-terms")
    table = spark.sparkContext.broadcast(_bits(pairs))

    def count_docs(batches):
        yield from _counts(table.value)(batches)

    rows = docs.select(F.col(f"`{key}`").cast("long").alias("row"), F.col(f"`{text}`").cast("string").alias("text"))
    counted = written(rows.mapInArrow(count_docs, f"row long, {_COUNTED}").filter("n > 0").withColumnRenamed("row", "key"), "document-terms")
    n_docs, n_terms = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()

    seen = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    # false matches of the bit table find no term here; terms that weigh nothing add nothing
    weighed = written(pairs.join(seen, "term").select("item", "term", "q", weight(n_docs, F.col("df")).alias("w")).filter("w > 0"), "weights")
    blocks = max(1, -(-weighed.count() // block_terms))
    out = spark.createDataFrame([], "item long, key long, score long")
    for block in range(blocks if n_docs else 0):
        own = weighed.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block)
        atoms, nodes = query_graph(own)
        # a block of the queries: its size is bounded by block_terms, however many documents there are
        graph = spark.sparkContext.broadcast(Graph(atoms.toArrow(), nodes.select("node", "parent", "atom", "q", "depth", "items").toArrow()))
        out = out.union(counted.mapInArrow(_evaluate(graph, n_docs, n_terms), "item long, key long, score long"))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("key"))
    best = out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= TOP)
    return best.join(named.select("item", "item_id"), "item").select("item_id", "rank", "key", "score")


def oracle() -> str:
    """The same in DuckDB."""
    words = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {words} AS words FROM documents),
s AS (SELECT count(*)::BIGINT AS docs, sum(len(words))::BIGINT AS terms FROM d WHERE len(words) > 0),
q AS (SELECT r, item_id, term, count(*) AS q FROM (SELECT r, item_id, unnest(words) AS term FROM (SELECT row_number() OVER () AS r, item_id, {words} AS words FROM benchmark)) GROUP BY ALL),
p AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(words) AS n, unnest(words) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2.0 * any_value(docs) + 2.0)::DOUBLE / (2.0 * count(*) + 1.0)::DOUBLE))::BIGINT AS w FROM p, s GROUP BY term),
c AS (SELECT p.r, p.doc_id, p.term, w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms))) AS c FROM p JOIN w USING (term), s),
t AS (SELECT q.r, item_id, doc_id, sum(q * c)::BIGINT AS score FROM q JOIN c USING (term) GROUP BY q.r, item_id, c.r, doc_id HAVING sum(q * c) > 0)
SELECT item_id, rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, doc_id)::INT AS rank FROM t) WHERE rank <= {TOP}"""


def op12_ranked_search(spark, sf_dir: str) -> DataFrame:
    """The ten best documents of each benchmark item: item_id, rank, doc_id, score."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return search(documents(spark, sf_dir), "doc_id", "text", items, "item_id", "text").withColumnRenamed("key", "doc_id")
