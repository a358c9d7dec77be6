"""Merkle dataset manifest: one tree a source, one tree of their roots, and a proof for every row.

A row is a leaf: the digest of its fields. The leaves of a source, by key, are reduced in runs of ``RUN`` nodes until one
is left, the subroot; the subroots, by source, are reduced alike to the root. A row's proof are the siblings on its way
to the root; folding a leaf with its proof gives the root again, unless the leaf was changed.

Cogrouped subtree exchange: ``RUN ** LEVELS`` consecutive nodes are a superblock, which reduces to one node by itself, in
``LEVELS`` levels. On the way up each superblock sends its top, and the tops of a tree are the nodes of the next level of
superblocks, until one is left. On the way down the nodes of a superblock meet the outer nodes that they need (the
siblings above its top, which the level above has found) in one cogroup: there the local reduction is finished, the
inner and outer parts of each proof are joined, and the leaves are folded.

At scale: texts are hashed where they are read and never move; what moves is a few digests a row. Places in a tree come
from a sort by ranges of (source, key) that splits a hot source over as many tasks as its size needs, and from the
counts of sorted pieces, so no source is gathered anywhere. A task holds one superblock and its outer siblings (some
kB), or a bundle of small trees of about as many rows. There are about log(rows) / log(4096) levels, each a written
table, so a lost executor costs a level at most. Nothing is gathered to the driver but counts.

Defined results: a null field is ``-``, so it differs from an empty one; a null source is a tree of its own and comes
first; null keys come first in a tree; rows of equal source and key are taken by leaf, so repeated rows are leaves each;
whole texts are hashed; an empty table gives an empty result; other columns are left out and can't clash.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlake.llm._session import documents, prepare, written

#: Consecutive nodes that become one, and levels that a superblock reduces by itself.
RUN, LEVELS = 16, 3
#: Sorted pieces (one for each source in each task) whose places are broadcast, at most.
BROADCAST_PIECES = 1 << 17
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: A row is changed, to test the proofs, where so much divides the crc32 of its key.
CHANGED = 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf(fields: list[Column]) -> Column:
    """The digest of a row: its fields as byte count, colon and value, or ``-``, one after another."""
    def spelt(field: Column) -> Column:
        text = field.cast("string")
        return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    return F.sha2(F.concat(*[spelt(f) for f in fields]), 256)


def _digest(joined: str) -> str:
    return hashlib.sha256(joined.encode()).hexdigest()


def height(n: int) -> int:
    """Levels that reduce ``n`` nodes to one."""
    levels = 0
    while n > 1:
        n, levels = -(-n // RUN), levels + 1
    return levels


def _reduced(digests: list[str], levels: int) -> list[list[str]]:
    """The nodes of a superblock, level by level."""
    out = [digests]
    for _ in range(levels):
        out.append([_digest("".join(out[-1][k : k + RUN])) for k in range(0, len(out[-1]), RUN)])
    return out


def _pieces(batches):
    """Of sorted rows (tree, ...): the number of the piece (rows of one tree in this partition) and the place in it."""
    part, piece, place, last = TaskContext.get().partitionId() << 32, -1, 0, object()
    for batch in batches:
        if not len(batch):
            continue
        column = batch.column("tree")
        codes, at = column.dictionary_encode(null_encoding="encode").indices.to_numpy(), np.arange(len(batch))
        new = np.ones(len(batch), bool)
        new[1:] = codes[1:] != codes[:-1]
        new[0] = column[0].as_py() != last
        start = np.maximum.accumulate(np.where(new, at, -1))
        number, places = piece + np.cumsum(new), np.where(start < 0, place + at, at - start)
        piece, place, last = int(number[-1]), int(places[-1]) + 1, column[-1].as_py()
        yield pa.RecordBatch.from_arrays([pa.array(part | number, pa.int64()), pa.array(places, pa.int64()), batch.column("row")], ["piece", "place", "row"])


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """A written table: ``rows`` (with a column ``tree``) and tid (a number for the tree), pos (the place in it) and n
    (its size). Trees and their rows are in ascending order, nulls first."""
    prepare(rows.sparkSession)
    by = ["tree", *order, "tie"]  # the tie lets copies of a row be split too
    ranged = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by)
    packed = ranged.select("tree", F.struct(*rows.columns).alias("row"))
    placed = written(packed.mapInArrow(_pieces, f"piece long, place long, row {packed.schema['row'].dataType.simpleString()}").select("piece", "place", "row.*"), "placed")
    pieces = placed.groupBy("tree", "piece").agg(F.count(F.lit(1)).alias("size"))
    whole, before = Window.partitionBy("tree"), Window.partitionBy("tree").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = written(pieces.select("piece", F.min("piece").over(whole).alias("tid"), F.sum("size").over(whole).alias("n"),
                                   F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start")), "pieces")
    if starts.count() <= BROADCAST_PIECES:
        starts = F.broadcast(starts)
    return placed.join(starts, "piece").select("tid", (F.col("start") + F.col("place")).alias("pos"), "n", *rows.columns)


def _dealt(nodes: DataFrame, total: int, size: int) -> DataFrame:
    """The group that a node's superblock is worked on in: its own one, or a bundle of trees of one superblock each."""
    bundles = max(1, -(-total // size))
    small = F.col("n") <= size
    sb = F.col("sb") if "sb" in nodes.columns else F.expr(f"pos div {size}")
    return nodes.withColumn("of", F.when(small, -1 - F.pmod(F.xxhash64("tid"), F.lit(bundles))).otherwise(F.col("tid"))).withColumn("super", F.when(small, 0).otherwise(sb).cast("long"))


_TOPS = "tid long, pos long, n long, digest string"
_OUTER = "tid long, sb long, n long, left array<string>, right array<string>, subroot string, root string"
_FOLDED = "key string, leaf string, subroot string, root string, proof_sha256 string, folded_root string"


def _joined(nodes: list[list[str]], outer):
    """For each node of a superblock: the siblings left and right of it on each level, inner ones first, then outer ones."""
    runs = [["".join(level[k : k + RUN]) for k in range(0, len(level), RUN)] for level in nodes[:-1]]
    left, right = list(outer["left"]), list(outer["right"])
    for place in range(len(nodes[0])):
        lefts, rights = [], []
        for level in runs:
            run, own = level[place // RUN], 64 * (place % RUN)
            lefts.append(run[:own])
            rights.append(run[own + 64 :])
            place //= RUN
        yield lefts + left, rights + right


class Superblocks:
    """Superblocks of ``levels`` levels: what tasks do with them, and the way up and down."""

    def __init__(self, levels: int = LEVELS):
        self.levels, self.size = levels, RUN**levels

    def _trees(self, group: pd.DataFrame):
        """The superblocks of a group: their rows by place, and their nodes level by level."""
        group = group.sort_values(["tid", "pos"], kind="stable")
        tid, sb = group["tid"].to_numpy(), group["pos"].to_numpy() // self.size
        cuts = np.flatnonzero(np.append(True, (tid[1:] != tid[:-1]) | (sb[1:] != sb[:-1]))) if len(group) else []
        for lo, hi in zip(cuts, [*cuts[1:], len(group)]):
            rows = group.iloc[lo:hi]
            yield int(tid[lo]), int(sb[lo]), rows, _reduced(rows["digest"].tolist(), min(self.levels, height(int(rows["n"].iloc[0]))))

    def tops(self, group: pd.DataFrame) -> pd.DataFrame:
        """Up: the top of each superblock, a node of the next level."""
        out = [(tid, sb, -(-int(rows["n"].iloc[0]) // self.size), nodes[-1][0]) for tid, sb, rows, nodes in self._trees(group)]
        return pd.DataFrame(out, columns=["tid", "pos", "n", "digest"])

    def _met(self, group: pd.DataFrame, outer: pd.DataFrame):
        known = {(t, s): row for t, s, row in zip(outer["tid"], outer["sb"], outer.to_dict("records"))}
        for tid, sb, rows, nodes in self._trees(group):
            yield rows, known[tid, sb], _joined(nodes, known[tid, sb])

    def down(self, nodes: pd.DataFrame, outer: pd.DataFrame, subroots: bool) -> pd.DataFrame:
        """Down, above the leaves: the outer siblings of the superblocks (or trees) whose tops these nodes are."""
        out = []
        for rows, above, paths in self._met(nodes, outer):
            for to, sb, n, own, (left, right) in zip(rows["to"], rows["to_sb"], rows["to_n"], rows["digest"], paths):
                out.append((to, sb, n, left, right, own if subroots else above["subroot"], above["root"]))
        return pd.DataFrame(out, columns=[x.split()[0] for x in _OUTER.split(", ")])

    def folded(self, nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        """Down, at the leaves: proofs, and what each leaf (changed, where it was) folds to."""
        out = []
        for rows, above, paths in self._met(nodes, outer):
            for key, own, changed, (left, right) in zip(rows["key"], rows["digest"], rows["changed"], paths):
                proof, node = hashlib.sha256(), changed if isinstance(changed, str) else own
                for a, b in zip(left, right):
                    proof.update((a + b).encode())
                    node = _digest(a + node + b)
                out.append((key, own, above["subroot"], above["root"], proof.hexdigest(), node))
        return pd.DataFrame(out, columns=[x.split()[0] for x in _FOLDED.split(", ")])

    def up(self, nodes: DataFrame) -> tuple[list[tuple[DataFrame, int]], DataFrame | None]:
        """The levels of nodes with their numbers of rows, and the tops of trees, one row (tid, digest) each."""
        levels, done = [], None
        total = nodes.count()
        while total:
            levels.append((nodes, total))
            dealt = _dealt(nodes.select("tid", "pos", "n", "digest"), total, self.size)
            tops = written(dealt.groupBy("of", "super").applyInPandas(lambda group: self.tops(group), _TOPS), "tops")
            ended = tops.filter("n = 1").select("tid", "digest")
            done = ended if done is None else done.union(ended)
            nodes = tops.filter("n > 1")
            total = nodes.count()
        return levels, done

    def cogrouped(self, nodes: DataFrame, total: int, outer: DataFrame, work, schema: str) -> DataFrame:
        """Nodes and the outer siblings of their superblocks, cogrouped by superblock."""
        sides = [_dealt(side, total, self.size).groupBy("of", "super") for side in (nodes, outer)]
        return sides[0].cogroup(sides[1]).applyInPandas(work, schema)

    def outer(self, levels: list[tuple[DataFrame, int]], outer: DataFrame) -> DataFrame:
        """Down, from the outer siblings of whole trees to those of the superblocks of the lowest level."""
        for (nodes, total), (below, _) in zip(levels[:0:-1], levels[-2::-1]):
            # a node of this level is the top of the superblock with its number in the level below
            sizes = below.groupBy("tid").agg(F.max("n").alias("to_n"))
            named = nodes.join(sizes, "tid").select("tid", "pos", "n", "digest", F.col("tid").alias("to"), F.col("pos").alias("to_sb"), "to_n")
            single = outer.join(nodes.select("tid").distinct(), "tid", "left_anti")  # trees that end below
            here = outer.join(nodes.groupBy("tid").agg(F.max("n").alias("own_n")), "tid").select("tid", "sb", F.col("own_n").alias("n"), "left", "right", "subroot", "root")
            outer = written(single.union(self.cogrouped(named, total, here, lambda group, above: self.down(group, above, False), _OUTER)), "outer")
        return outer


def proofs(rows: DataFrame, levels: int = LEVELS) -> DataFrame:
    """For rows (tree, key, digest, changed), leaves: key, leaf, subroot, root, proof_sha256, folded_root (from
    ``changed`` where it isn't null)."""
    spark, blocks = prepare(rows.sparkSession), Superblocks(levels)
    leaves = written(numbered(rows, ["key", "digest"]), "leaves")
    lower, subroots = blocks.up(leaves)
    if not lower:
        return spark.createDataFrame([], _FOLDED).withColumn("key", F.col("key").cast("long"))
    trees = leaves.groupBy("tid").agg(F.min("tree").alias("name"), F.max("n").alias("to_n"))
    # the tree of trees: its leaves are the subroots, in the order of their sources
    ends = subroots.join(trees, "tid").select(F.lit("").alias("tree"), "name", F.col("tid").alias("to"), F.lit(0).cast("long").alias("to_sb"), "to_n", "digest")
    tops = written(numbered(ends, ["name"]), "subroots")
    upper, root = blocks.up(tops)
    none = F.array().cast("array<string>")
    size = tops.groupBy("tid").agg(F.max("n").alias("n"))
    outer = root.join(size, "tid").select("tid", F.lit(0).cast("long").alias("sb"), "n", none.alias("left"), none.alias("right"), F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"))
    outer = written(blocks.cogrouped(tops.drop("tree", "name"), upper[0][1], blocks.outer(upper, outer), lambda group, above: blocks.down(group, above, True), _OUTER), "outer")
    # keys travel as text: pandas would turn integers with nulls into doubles
    named = leaves.drop("tree").withColumn("key", F.col("key").cast("string"))
    found = blocks.cogrouped(named, lower[0][1], blocks.outer(lower, outer), lambda group, above: blocks.folded(group, above), _FOLDED)
    return found.withColumn("key", F.col("key").cast("long"))


def manifest(docs: DataFrame, group: str, key: str, fields: list[str], changes: dict[str, Column] | None = None, where: Column | None = None,
             levels: int = LEVELS) -> DataFrame:
    """Proofs of all rows of ``docs``: trees by ``group``, leaves of ``fields`` by ``key`` (an integer). ``changes`` gives
    other values of fields, ``where`` the rows that have them when their leaves are folded."""
    own = [F.col(f"`{f}`") for f in fields]
    other = F.lit(None).cast("string")
    if changes:
        other = F.when(F.lit(True) if where is None else where, leaf([changes.get(f, F.col(f"`{f}`")) for f in fields]))
    rows = docs.select(F.col(f"`{group}`").cast("string").alias("tree"), F.col(f"`{key}`").cast("long").alias("key"), leaf(own).alias("digest"), other.alias("changed"))
    return proofs(written(rows, "digests"), levels)


def op13_merkle_manifest(spark, sf_dir: str, levels: int = LEVELS) -> DataFrame:
    """Per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    docs = documents(spark, sf_dir).select(*FIELDS)
    picked = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(CHANGED)) == 0
    found = manifest(docs, "source", "doc_id", list(FIELDS), {"text": F.translate("text", _UPPER, _LOWER)}, picked, levels)
    return found.select(F.col("key").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _level_sql(name: str, i: int) -> str:
    """One level of trees (tid, pos, d, n) in DuckDB: the siblings of each node, and the level above."""
    run = f"(PARTITION BY tid, pos // {RUN} ORDER BY pos ROWS BETWEEN "
    return f"""
{name}{i}s AS (SELECT tid, pos, n, CASE WHEN n = 1 THEN '' ELSE coalesce(string_agg(d, '') OVER {run}UNBOUNDED PRECEDING AND 1 PRECEDING), '') END AS l,
    CASE WHEN n = 1 THEN '' ELSE coalesce(string_agg(d, '') OVER {run}1 FOLLOWING AND UNBOUNDED FOLLOWING), '') END AS r FROM {name}{i}),
{name}{i + 1} AS (SELECT tid, pos // {RUN} AS pos, CASE WHEN max(n) = 1 THEN max(d) ELSE sha256(string_agg(d, '' ORDER BY pos)) END AS d,
    CASE WHEN max(n) = 1 THEN 1 ELSE (max(n) + {RUN - 1}) // {RUN} END AS n FROM {name}{i} GROUP BY tid, pos // {RUN}),"""


def oracle(levels: int = 5) -> str:
    """The same in DuckDB, level by level, for at most ``RUN ** levels`` rows a source and as many sources."""
    spelt = lambda c: f"coalesce(strlen({c}::VARCHAR) || ':' || ({c}::VARCHAR), '-')"
    row = lambda text: "sha256(" + " || ".join([*map(spelt, FIELDS[:-1]), spelt(text)]) + ")"
    step = "list_reduce(list_prepend(xor(c, y), range(8)), lambda v, b: xor(v >> 1, (v & 1) * 3988292384))"
    crc = f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: unicode(x)::BIGINT)), lambda c, y: {step}), 4294967295)"
    climb = lambda name, tid: " ".join(f"JOIN {name}{i}s {name}{i} ON {name}{i}.tid = {tid} AND {name}{i}.pos = {{pos}} // {RUN**i}" for i in range(levels))
    out = f"""
WITH base AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tid, {row('text')} AS leaf,
    CASE WHEN {crc} % {CHANGED} = 0 THEN {row(f"translate(text, '{_UPPER}', '{_LOWER}')")} END AS changed FROM documents),
leaves AS (SELECT doc_id, tid, leaf, coalesce(changed, leaf) AS start, row_number() OVER (PARTITION BY tid ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY tid) AS n FROM base),
a0 AS (SELECT tid, pos, leaf AS d, n FROM leaves),"""
    out += "".join(_level_sql("a", i) for i in range(levels))
    out += f"\nb0 AS (SELECT 0 AS tid, tid AS pos, d, count(*) OVER () AS n FROM a{levels}),"
    out += "".join(_level_sql("b", i) for i in range(levels))
    parts = [f"{name}{i}" for name in "ab" for i in range(levels)]
    out += f"""
paths AS (SELECT doc_id, leaf, top.d AS subroot, root.d AS root, sha256({' || '.join(f'{p}.l || {p}.r' for p in parts)}) AS proof_sha256, start, {', '.join(f'{p}.l AS {p}l, {p}.r AS {p}r, {p}.n AS {p}n' for p in parts)}
    FROM leaves x {climb('a', 'x.tid').format(pos='x.pos')} JOIN a{levels} top ON top.tid = x.tid {climb('b', '0').format(pos='x.tid')} JOIN b{levels} root ON root.tid = 0),"""
    state = "start"
    for k, p in enumerate(parts):
        out += f"\nf{k} AS (SELECT * EXCLUDE ({state}), CASE WHEN {p}n = 1 THEN {state} ELSE sha256({p}l || {state} || {p}r) END AS node{k} FROM {'paths' if k == 0 else f'f{k - 1}'}),"
        state = f"node{k}"
    return out.rstrip(",") + f"\nSELECT doc_id, leaf, subroot, root, proof_sha256, {state} AS folded_root, {state} = root AS verified FROM f{len(parts) - 1}"
