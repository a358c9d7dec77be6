"""Connected components: contraction within tasks and rounds of stars, against a plain union."""
import random

import numpy as np
import pytest

from gridlake.llm import _components


def union(edges):
    """The least node of each node's component."""
    parent = {}

    def top(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        x, y = top(a), top(b)
        parent[max(x, y)] = min(x, y)
    return {x: top(x) for x in list(parent) if any(x in e and e[0] != e[1] for e in edges) or top(x) != x}


def graph(kind):
    random.seed(kind)
    if kind == "path":
        names = random.sample(range(10_000), 900)
        return list(zip(names, names[1:]))
    if kind == "hub":
        return [(7, 1000 + k) for k in range(1500)] + [(1000, 3)]
    if kind == "cliques":
        return [(100 * g + random.randrange(20), 100 * g + random.randrange(20)) for g in range(40) for _ in range(60)]
    return [(random.randrange(1500), random.randrange(1500)) for _ in range(900)]


@pytest.mark.parametrize("kind", ["path", "hub", "cliques", "random"])
@pytest.mark.parametrize("limit", [1 << 20, 64])
def test_components_of_whole_graphs(spark, kind, limit):
    edges = graph(kind) + [(5_000_000_000 + k, 5_000_000_001 + k) for k in (0, 1)] + [(42, 42)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(6)
    got = {r["node"]: r["component"] for r in _components.components(df, limit).collect()}
    parts = [e for e in edges if e[0] != e[1]]
    want = union(parts)
    assert got == want


def test_no_edges_and_copies(spark):
    empty = spark.createDataFrame([], "a long, b long")
    assert _components.components(empty).count() == 0
    again = spark.createDataFrame([(2, 1)] * 50 + [(1, 2)] * 50 + [(1, 1)], "a long, b long").repartition(4)
    for limit in (1 << 20, 1):
        assert sorted(map(tuple, _components.components(again, limit).collect())) == [(1, 1), (2, 1)]


def test_stars_of_a_task():
    a, b = _components.stars(np.array([5, 9, 9, 1, 4]), np.array([9, 5, 7, 1, 3]))
    assert sorted(zip(a.tolist(), b.tolist())) == [(4, 3), (7, 5), (9, 5)]
