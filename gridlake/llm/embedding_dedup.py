"""Embedding near-deduplication: a forest of random-projection trees with spill.

A tree splits the vectors by recursive random cuts: a random direction (the difference of two random vectors of the
node's sample), a cut at the median projection, and a spill: vectors near the cut go to both sides (fewer on each level
further down, so that the leaves of a vector don't grow with the depth of the trees). Trees are fitted
on a bounded sample (``SAMPLE`` vectors with the least hashes), every vector goes down every tree. Leaves that hold more
than ``LEAF`` vectors are split again, by trees fitted on a bounded sample of each such leaf, until none is too large or
splitting gains nothing. Within a leaf all pairs are compared by cosine in double precision.

Cuts would tear a dense group apart, so dense groups larger than a leaf are met as a whole before the trees: where the
sample shows one, all vectors within the linking angle of its centre are its members, and meet each other and all
vectors within twice that angle, block by block. By the triangle inequality those are all that a member can link with,
so links of members are exact, and members need no tree. A node of a tree whose sample pairs link often isn't cut.

Equal vectors are one from the start, with their number: copies link without comparison. A pair that shares leaves is
counted in the first one alone (each vector knows its leaves), so links are counted without a row for each pair; for
groups a leaf sends a spanning forest of its links. So a leaf sends as many rows as it has vectors. What is sent to
a leaf is a vector in the precision of the table and its leaves so far, once; units are made anew in the task.

A leaf that can't be split (a dense one, or vectors that spill to both sides) is dealt out in blocks instead: each of
its blocks meets each other one in a task of its own, so that memory stays bounded and no pair is left out.

Defined results: a null or empty vector, one with a null or non-finite component, or one of zeros links with nothing;
vectors of unlike lengths never link; repeated rows (equal vec_id too) are copies and count as other vectors; an empty
table gives an empty result; labels and other columns are not read.
"""
from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from gridlake.llm._components import components
from gridlake.llm._session import prepare, written

COSINE = 0.9
TREES = 16
SAMPLE = 20_000
LEAF = 1024
#: Share of a node's sample within the spill on each side of the cut, and what is left of it from a level to the next: so a
#: vector goes to about twice as many leaves as there are trees, however deep they are.
SPILL, NARROWER = 0.12, 0.75
#: Members of a dense group that is met as a whole: an estimated share of ``LEAF`` and a number in the sample at least.
GROUP, SEEN = 0.25, 16
#: A node isn't cut if so large a share of its sample's pairs link.
DENSE = 0.2
#: Rounds of splitting large leaves, the largest ones of a round, and the sample of each. What is still large after the
#: last round is met block by block.
ROUNDS = 8
SPLITS = 256
LEAF_SAMPLE = 4_000
SEED = 2024
#: Leaves met block by block (24 bytes each) that are handed to all tasks, at most.
BROADCAST_LEAVES = 1 << 20
#: Mark of a leaf that can't be split.
_STUCK = 1 << 39


class Tree:
    """Cuts as arrays; a node is a leaf if its direction is missing."""

    def __init__(self, sample: np.ndarray, leaf: int, rng: np.random.Generator, least: float = COSINE, above: float = 0.0):
        self.least, self.above = least, above  # levels above the root: a tree that splits a leaf again goes on from there
        self.directions: list[np.ndarray | None] = []
        self.bounds: list[tuple[float, float]] = []
        self.children: list[tuple[int, int]] = []
        self._grow(sample, leaf, rng, 0)

    def _grow(self, rows: np.ndarray, leaf: int, rng: np.random.Generator, depth: int) -> int:
        me = len(self.directions)
        self.directions.append(None)
        self.bounds.append((0.0, 0.0))
        self.children.append((-1, -1))
        if len(rows) <= leaf or depth >= 40:
            return me
        a, b = rng.integers(0, len(rows), (2, 512))
        if (np.einsum("ij,ij->i", rows[a], rows[b])[a != b] >= self.least).mean() >= DENSE:
            return me
        for _ in range(4):
            a, b = rows[rng.choice(len(rows), 2, replace=False)]
            at = rows @ (a - b)
            spill = SPILL * NARROWER ** (self.above + depth)
            low, high = np.quantile(at, [0.5 - spill, 0.5 + spill])
            left, right = at <= high, at >= low
            if max(left.sum(), right.sum()) < 0.9 * len(rows):
                break
        else:
            return me
        self.directions[me], self.bounds[me] = a - b, (float(low), float(high))
        self.children[me] = (self._grow(rows[left], leaf, rng, depth + 1), self._grow(rows[right], leaf, rng, depth + 1))
        return me

    def leaves(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a row and a leaf that it goes to."""
        found, todo = [], [(0, np.arange(len(rows)))]
        while todo:
            node, own = todo.pop()
            if self.directions[node] is None:
                found.append((own, np.full(len(own), node)))
                continue
            at = rows[own] @ self.directions[node]
            low, high = self.bounds[node]
            todo.append((self.children[node][0], own[at <= high]))
            todo.append((self.children[node][1], own[at >= low]))
        return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def _scaled(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=-1, keepdims=True)  # so that squares neither vanish nor overflow
    return x / np.sqrt((x * x).sum(axis=-1, keepdims=True)) + 0.0


def _matrix(column) -> np.ndarray:
    """Unit vectors in double precision, from vectors as bytes: a mark of the precision (4 or 8), then the numbers."""
    found = column.to_pylist()
    if not found:
        return np.empty((0, 0))
    raw = np.frombuffer(b"".join(found), np.uint8).reshape(len(found), -1)
    return _scaled(np.ascontiguousarray(raw[:, 1:]).view(f"f{raw[0, 0]}").astype(np.float64))


def _usable(size: int):
    """Unit vectors in double precision as bytes, and vectors as they are, in ``size`` bytes a number; null for a vector
    that links with nothing."""
    def run(batches):
        for batch in batches:
            units, raws = [], []
            for v in batch.column("v").to_pylist():
                unit = raw = None
                if v and all(x is not None for x in v):
                    x = np.array(v, np.float64)
                    if np.isfinite(x).all() and x.any():
                        unit, raw = _scaled(x).tobytes(), bytes([size]) + x.astype(f"f{size}").tobytes()
                units.append(unit)
                raws.append(raw)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(units, pa.binary()), pa.array(raws, pa.binary())], ["row", "unit", "raw"])
    return run


def _sampled(rows: DataFrame, n: int) -> np.ndarray:
    held = rows.select("unit", F.xxhash64("unit").alias("h")).orderBy("h", "unit").limit(n).select("unit").collect()
    return _matrix(pa.array([r["unit"] for r in held], pa.binary()))


def _near(rows: np.ndarray, others: np.ndarray, least: float) -> np.ndarray:
    """Per row, how many of the others it links with."""
    out = np.zeros(len(rows), np.int64)
    for at in range(0, len(rows), 512):
        out[at : at + 512] = (rows[at : at + 512] @ others.T >= least).sum(1)
    return out


def dense_centres(sample: np.ndarray, n: int, leaf: int, least: float, trees: int) -> np.ndarray:
    """Centres of the dense groups of a sample of ``n`` vectors, the largest first. A group that fewer meet by the trees
    than by its surroundings is left to the trees."""
    wanted = max(SEEN, GROUP * leaf * len(sample) / max(1, n))
    centres, left = [], sample.astype(np.float32)
    whole = left
    if n <= leaf or least <= 0:  # one leaf; or the surroundings are everything
        return np.empty((0, sample.shape[1]))
    near = _near(left, left, least)
    while len(left) and near.max() >= wanted:
        first = left[near.argmax()]
        own = left @ first >= least
        mean = left[own].sum(0)
        mean /= np.linalg.norm(mean)
        centre, inside = (mean, own_mean) if (own_mean := left @ mean >= least).sum() >= own.sum() else (first, own)
        if (whole @ centre >= 2 * least * least - 1).sum() <= trees * inside.sum():
            centres.append(centre.astype(np.float64) / np.linalg.norm(centre.astype(np.float64)))
        gone, left = left[inside], left[~inside]
        near = near[~inside] - _near(left, gone, least)
    return np.array(centres).reshape(-1, sample.shape[1])


def _pairs_in(a: np.ndarray, least: float):
    """Pairs of rows with a cosine of at least ``least``, in blocks of rows."""
    for at in range(0, len(a), 512):
        dots = a[at : at + 512] @ a[at:].T
        i, j = np.nonzero(dots >= least)
        keep = j > i
        yield i[keep] + at, j[keep] + at


def _by_tree(leaves: pa.Array) -> list[np.ndarray]:
    """Lists of leaves, as a table for each tree: a row for each list, filled up with -1."""
    ends = np.cumsum(pc.list_value_length(leaves).to_numpy(zero_copy_only=False))
    flat, row = pc.list_flatten(leaves).to_numpy(), pc.list_parent_indices(leaves).to_numpy()
    tables = []
    for tree in np.unique(flat >> 40):
        own = np.flatnonzero(flat >> 40 == tree)
        rows = row[own]
        place = np.arange(len(own)) - np.searchsorted(rows, rows)
        table = np.full((len(ends), place.max() + 1), -1, np.int64)
        table[rows, place] = flat[own]
        tables.append(table)
    return tables


def _earlier(tables: list[np.ndarray], p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Which pairs share one of the leaves in the tables."""
    found = np.zeros(len(p), bool)
    open_ = np.arange(len(p))
    for table in tables:
        own, other = table[p[open_]], table[q[open_]]
        shared = np.zeros(len(open_), bool)
        for k in range(table.shape[1]):
            shared |= ((own == other[:, k : k + 1]) & (own >= 0)).any(1)
        found[open_[shared]] = True
        open_ = open_[~shared]
    return found


def _compare(least: float):
    def run(key, group):
        """Links of one leaf (or of two blocks of it): per vector the number of other vectors, and a spanning forest."""
        here = key[0].as_py()
        group = group.combine_chunks().sort_by("id")
        ids, copies = group.column("id").to_numpy(), group.column("copies").to_numpy()
        side = group.column("side").to_numpy()
        # of a leaf of a tree, pairs that share an earlier leaf are left out; a dense group has its pairs for itself
        tables = _by_tree(group.column("leaves").combine_chunks()) if here >= 0 else []
        units = _matrix(group.column("unit"))
        links, root, edges = np.zeros(len(ids), np.int64), np.arange(len(ids)), []
        for i, j in _pairs_in(units, least):
            apart = (side[i] != side[j]) | (side[i] == 0)
            i, j = i[apart], j[apart]
            for at in range(0, len(i), 1 << 14):
                p, q = i[at : at + (1 << 14)], j[at : at + (1 << 14)]
                if tables:
                    first = ~_earlier(tables, p, q)
                    p, q = p[first], q[first]
                np.add.at(links, p, copies[q])
                np.add.at(links, q, copies[p])
                new = np.flatnonzero(root[p] != root[q])
                if not len(new):
                    continue
                _, one = np.unique(root[p[new]] * len(ids) + root[q[new]], return_index=True)
                parent = {}

                def top(x: int) -> int:
                    while x in parent:
                        x = parent[x]
                    return x

                for k in new[one].tolist():
                    a, b = top(int(root[p[k]])), top(int(root[q[k]]))
                    if a != b:
                        parent[max(a, b)] = min(a, b)
                        edges.append((ids[p[k]], ids[q[k]]))
                moved = np.arange(len(ids))
                for x in parent:
                    moved[x] = top(x)
                root = moved[root]
        some = np.flatnonzero(links)
        a = np.concatenate([ids[some], np.array([e[0] for e in edges], np.int64)])
        b = np.concatenate([np.full(len(some), -1), np.array([e[1] for e in edges], np.int64)])
        n = np.concatenate([links[some], np.zeros(len(edges), np.int64)])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "n": pa.array(n, pa.int64())})
    return run


def _assigned(vectors: DataFrame, rows: np.ndarray, n: int, least: float, trees: int, leaf: int, seed: int) -> DataFrame:
    """(id, unit, copies, leaf): every vector in every leaf that it goes to; leaf numbers ascend by tree. ``rows`` are a
    sample of the ``n`` vectors."""
    spark = vectors.sparkSession
    # in the sample, a leaf has as many vectors as its share of the limit
    size = max(8, int(leaf * min(1.0, len(rows) / max(1, n)) * 0.8))
    if len(rows) * leaf < 8 * n:
        size = 8
    if n <= leaf:
        size = len(rows)
        trees = 1
    forest = [Tree(rows, size, np.random.default_rng([seed, t]), least) for t in range(trees)]
    shared = spark.sparkContext.broadcast(forest)

    def run(batches):
        for batch in batches:
            units = _matrix(batch.column("unit"))
            found = [(r, l.astype(np.int64) | (t << 40)) for t, tree in enumerate(shared.value) for r, l in [tree.leaves(units)]]
            row, place = np.concatenate([r for r, _ in found]), np.concatenate([x for _, x in found])
            order = np.lexsort((place, row))
            cut = np.searchsorted(row[order], np.arange(1, len(batch)))
            lists = pa.array([x.tolist() for x in np.split(place[order], cut)], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("unit"), batch.column("copies"), lists], ["id", "unit", "copies", "leaves"])

    return written(vectors.mapInArrow(run, "id long, unit binary, copies long, leaves array<long>"), "leaves")


def _split(assigned: DataFrame, n: int, limit: int, seed: int, least: float) -> DataFrame:
    """Split leaves beyond the limit again; a leaf's parts get numbers of their own in the leaf's tree."""
    spark = assigned.sparkSession
    for turn in range(1, ROUNDS + 1):
        sizes = assigned.select(F.explode("leaves").alias("leaf")).groupBy("leaf").count().filter(F.col("count") > limit)
        sizes = sizes.filter(F.col("leaf").bitwiseAND(F.lit(_STUCK)) == 0).orderBy(F.desc("count"), "leaf").limit(SPLITS)
        large = {r["leaf"]: r["count"] for r in sizes.collect()}
        if not large:
            break
        wanted = sorted(large)
        names = spark.createDataFrame([(x,) for x in wanted], "leaf long")
        rank = F.row_number().over(Window.partitionBy("leaf").orderBy(F.xxhash64("unit"), "unit"))
        picked = assigned.select("unit", F.explode("leaves").alias("leaf")).join(F.broadcast(names), "leaf").withColumn("rank", rank).filter(F.col("rank") <= LEAF_SAMPLE)
        fitted = {}

        def fit(key, group):
            at, rows = key[0].as_py(), _matrix(group.column("unit").combine_chunks())
            share = min(1.0, len(rows) / large[at])
            tree = Tree(rows, max(8, int(limit * share * 0.8)), np.random.default_rng([seed, turn, at & 0xFFFFFFFF]), least, max(0.0, float(np.log2(n / large[at]))))
            return pa.table({"leaf": pa.array([at], pa.int64()), "tree": pa.array([pickle.dumps(tree)], pa.binary())})

        for r in picked.groupBy("leaf").applyInArrow(fit, "leaf long, tree binary").collect():
            fitted[r["leaf"]] = pickle.loads(r["tree"])
        shared = spark.sparkContext.broadcast(fitted)
        number = {x: k for k, x in enumerate(sorted(fitted))}
        base = turn << 32

        def again(batches):
            for batch in batches:
                units, lists = _matrix(batch.column("unit")), batch.column("leaves")
                flat = pc.list_flatten(lists).to_numpy()
                row = np.repeat(np.arange(len(batch)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
                # the batch's places in leaves that are split, leaf by leaf
                some = np.flatnonzero(np.isin(flat, list(number)))
                some = some[np.argsort(flat[some], kind="stable")]
                stays = np.ones(len(flat), bool)
                stays[some] = False
                rows, leaves = [row[stays]], [flat[stays]]
                ends = np.flatnonzero(np.diff(flat[some], append=-1)) + 1
                for own in np.split(some, ends[:-1]) if len(some) else []:
                    leaf = int(flat[own[0]])
                    tree = shared.value[leaf]
                    if tree.directions[0] is None:  # can't be split
                        rows.append(row[own])
                        leaves.append(np.full(len(own), leaf | _STUCK))
                        continue
                    member, node = tree.leaves(units[row[own]])
                    rows.append(row[own][member])
                    leaves.append((leaf >> 40 << 40) | base | (number[leaf] << 16) | node.astype(np.int64))
                rows, leaves = np.concatenate(rows), np.concatenate(leaves)
                leaves = leaves[np.lexsort((leaves, rows))]
                starts = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(batch)))])
                out = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(leaves, pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("unit"), batch.column("copies"), out], ["id", "unit", "copies", "leaves"])

        assigned = written(assigned.mapInArrow(again, "id long, unit binary, copies long, leaves array<long>"), "leaves")
    return assigned


def _marks(centres: np.ndarray, least: float):
    """``own``: minus the number of the first dense group that a vector is a member of, or 0; ``around``: that group, and
    those before it whose members it may link with. So a pair with a member meets in one group, the first of them."""
    bound = 2 * least * least - 1 - 1e-9

    def run(batches):
        for batch in batches:
            at = _matrix(batch.column("unit")) @ centres.T if len(batch) else np.empty((0, len(centres)))
            inside = at >= least
            first = np.where(inside.any(1), inside.argmax(1), len(centres))
            number = np.arange(len(centres))
            near = (at >= bound) & (number <= first[:, None])
            around = [(-1 - number[x]).tolist() for x in near]
            own = np.where(first < len(centres), -1 - first, 0)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("unit"), batch.column("copies"), pa.array(own, pa.int64()), pa.array(around, pa.list_(pa.int64()))], ["id", "unit", "copies", "own", "around"])
    return run


def links(vectors: DataFrame, least: float = COSINE, trees: int = TREES, leaf: int = LEAF, sample: int = SAMPLE, seed: int = SEED) -> DataFrame:
    """From distinct (id, unit, copies): (id, n_links, component) of those that link with another one."""
    rows, n = _sampled(vectors, sample), vectors.count()
    centres = dense_centres(rows, n, leaf, least, trees)
    grouped = None
    if len(centres):
        marked = written(vectors.mapInArrow(_marks(centres, least), "id long, unit binary, copies long, own long, around array<long>"), "marked")
        grouped = marked.select("id", "unit", "copies", "own", F.explode("around").alias("leaf"))
        vectors = marked.filter("own = 0").select("id", "unit", "copies")
        rows, n = _sampled(vectors, sample), vectors.count()
    placed = None
    if n:
        assigned = _split(_assigned(vectors, rows, n, least, trees, leaf, seed), n, leaf, seed, least)
        placed = assigned.select("id", "unit", "copies", "leaves", F.explode("leaves").alias("leaf"))
        earlier = F.filter("leaves", lambda x: x < F.col("leaf"))
        placed = placed.select("leaf", "id", "unit", "copies", earlier.alias("leaves"), F.lit(True).alias("inside"))
    if grouped is not None:
        grouped = grouped.select("leaf", "id", "unit", "copies", F.array().cast("array<long>").alias("leaves"), (F.col("own") == F.col("leaf")).alias("inside"))
        placed = grouped if placed is None else placed.union(grouped)
    return _met(placed, least, leaf)


def _met(placed: DataFrame, least: float, leaf: int) -> DataFrame:
    """Links from vectors in leaves: leaf, id, unit, copies, leaves (earlier ones), inside (not only around a group)."""
    # a leaf beyond twice the limit is met block by block: pairs of blocks, each in a group of its own; blocks of vectors
    # around a dense group meet those of its members alone. Only large leaves are looked up, so that vectors move once.
    counts = placed.groupBy("leaf").agg(F.count_if("inside").alias("n_in"), F.count_if(~F.col("inside")).alias("n_out"))
    counts = counts.withColumn("b_in", F.ceil(F.col("n_in") / (2 * leaf)).cast("int")).withColumn("b_out", F.ceil(F.col("n_out") / (2 * leaf)).cast("int"))
    large = written(counts.filter("b_in > 1 or b_out > 0").select("leaf", "b_in", "b_out"), "large")
    # their number grows with the table: beyond the bound, vectors are joined by leaf
    large = F.broadcast(large) if large.count() <= BROADCAST_LEAVES else large
    placed = placed.join(large, "leaf", "left").withColumn("b_in", F.coalesce("b_in", F.lit(1))).withColumn("b_out", F.coalesce("b_out", F.lit(0))).filter("b_in > 0")
    own = F.when(F.col("inside"), F.pmod(F.xxhash64("id"), F.col("b_in"))).otherwise(F.col("b_in") + F.pmod(F.xxhash64("id"), F.greatest("b_out", F.lit(1)))).cast("int")
    last = F.when(F.col("inside"), F.col("b_in") + F.col("b_out") - 1).otherwise(F.col("b_in") - 1)
    placed = placed.withColumn("own", own)
    others = F.transform(F.sequence(F.lit(0), last), lambda b: F.struct(F.least("own", b).alias("lo"), F.greatest("own", b).alias("hi")))
    met = placed.withColumn("meet", F.explode(others))
    # 0: compared with all; 1 and 2: with the other side only
    side = F.when(F.col("meet.lo") == F.col("meet.hi"), 0).when(F.col("own") == F.col("meet.lo"), 1).otherwise(2)
    met = met.select("leaf", F.col("meet.lo").alias("lo"), F.col("meet.hi").alias("hi"), "id", "unit", "copies", "leaves", side.cast("long").alias("side"))
    found = written(met.groupBy("leaf", "lo", "hi").applyInArrow(_compare(least), "a long, b long, n long"), "links")
    counted = found.filter("b < 0").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("n_links"))
    groups = components(found.filter("b >= 0").select("a", "b"))
    return counted.join(groups, F.col("id") == F.col("node")).select("id", "n_links", "component")


def dedup(df: DataFrame, key: str, vector: str, least: float = COSINE, **options) -> DataFrame:
    """Per row: key, n_links, component_id (the least key of its group), kept (the key is that one)."""
    prepare(df.sparkSession)
    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{key}`").alias("key"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    rows = written(rows, "vectors")
    # numbers of a table of floats are held in 4 bytes
    held = df.select(F.col(f"`{vector}`")).schema[0].dataType
    size = 4 if isinstance(held, ArrayType) and isinstance(held.elementType, FloatType) else 8
    units = rows.select("row", "v").mapInArrow(_usable(size), "row long, unit binary, raw binary")
    units = written(rows.select("row", "key").join(units, "row"), "units")
    distinct = written(units.filter("unit is not null").groupBy("unit").agg(F.min("row").alias("id"), F.count(F.lit(1)).alias("copies"), F.min("key").alias("least"), F.min("raw").alias("raw")), "distinct")
    # vectors of unlike lengths never meet; a length that fits in a leaf is one, and all such lengths go in one pass
    leaf = options.get("leaf", LEAF)
    size = F.length("raw")
    lengths = written(distinct.groupBy(size.cast("long").alias("leaf")).count(), "lengths")
    some = distinct.select("id", F.col("raw").alias("unit"), "copies", size.cast("long").alias("leaf"))
    small = some.join(lengths.filter(F.col("count") <= leaf).select("leaf"), "leaf")
    found = _met(small.withColumn("leaves", F.array().cast("array<long>")).withColumn("inside", F.lit(True)), least, leaf)
    for r in lengths.filter(F.col("count") > leaf).collect():
        found = found.union(links(some.filter(F.col("leaf") == r["leaf"]).drop("leaf"), least, **options))
    ids = distinct.select("id", "unit", "copies", "least")
    ids = ids.join(found, "id", "left")
    ids = written(ids.select("unit", "least", (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("grp")), "linked")
    least_of = ids.groupBy("grp").agg(F.min("least").alias("component_id"))
    ids = ids.join(least_of, "grp").select("unit", "n_links", "component_id")
    linked = units.filter("unit is not null").join(ids, "unit").select("key", "n_links", "component_id")
    alone = units.filter("unit is null").select("key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"))
    return linked.union(alone).select(F.col("key").alias(key), "n_links", "component_id", F.col("key").eqNullSafe(F.col("component_id")).alias("kept"))


def op7_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    """Per vector: vec_id, n_links, component_id, kept."""
    return dedup(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding")
