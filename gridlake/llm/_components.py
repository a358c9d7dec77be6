"""Connected components of a graph given as edges: contraction within tasks, then alternating large and small stars.

Each partition of edges is contracted where it lies: its edges become stars around the least nodes of their components,
one edge for each other node. Once at most ``TASK_EDGES`` edges are left, one task of that bounded size ends the work.
Larger graphs go on in rounds: each points every node at the least neighbour it knows of, by large and small stars, and
contracts again; rounds grow with the logarithm of the longest path. Every round is written to the shared folder, so a
lost executor costs one round. The number of rows never grows beyond the edges. A node with very many neighbours is a key
of the joins alone: sums are made before the shuffle, and adaptive execution splits its join partition.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm._session import prepare, written

#: Edges that one task contracts (16 bytes each).
TASK_EDGES = 1 << 20


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node of the edges but the least one of its component, and that least one."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while len(x):
        low, high = np.minimum(label[x], label[y]), np.maximum(label[x], label[y])
        apart = low < high
        if not apart.any():
            break
        x, y = x[apart], y[apart]
        np.minimum.at(label, high[apart], low[apart])
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
    other = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[other], nodes[label[other]]


def _contract(limit: int):
    def run(batches):
        held, size = [], 0

        def contracted():
            return stars(*(np.concatenate([h[k] for h in held]) if held else np.empty(0, np.int64) for k in (0, 1)))

        def rows(pair):
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in pair], ["a", "b"])

        for batch in batches:
            held.append(tuple(batch.column(c).to_numpy() for c in ("a", "b")))
            size += len(batch)
            if size > 2 * limit:
                held = [contracted()]
                size = len(held[0][0])
                if size > limit:  # too many nodes to wait for more edges
                    yield rows(held[0])
                    held, size = [], 0
        yield rows(contracted())
    return run


def _least(pairs: DataFrame) -> DataFrame:
    """(u, v) pairs with the least of u and all its v as m."""
    m = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(m, "u")


def _mark(edges: DataFrame) -> tuple:
    h = F.xxhash64("a", "b")
    row = edges.agg(F.count(F.lit(1)), F.sum(F.shiftright(h, 20)), F.bit_xor(h)).first()
    return tuple(row)


def _round(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    large = _least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
    small = _least(large)
    found = small.select(F.col("v").alias("a"), F.col("m").alias("b")).union(small.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return found.filter("a <> b").distinct()


def components(edges: DataFrame, task_edges: int = TASK_EDGES) -> DataFrame:
    """(node, component) for each node of the edges (a, b), numbers; the component is its least node."""
    prepare(edges.sparkSession)
    contract = lambda e: e.mapInArrow(_contract(task_edges), "a long, b long")
    edges = written(contract(edges.select(F.col("a").cast("long"), F.col("b").cast("long"))), "edges")
    mark = _mark(edges)
    while mark[0] > task_edges:
        edges = written(_round(contract(edges)), "edges")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    else:
        edges = written(contract(edges.coalesce(1)), "edges")
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
