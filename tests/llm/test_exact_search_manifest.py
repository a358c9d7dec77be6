"""Exact deduplication, ranked search and the Merkle manifest: against brute force."""
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridlake.llm import exact_dedup, merkle, ranked_search
from tests.llm.conftest import AWKWARD, SF

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- counting quotient filters

@pytest.mark.parametrize("bits", [2, 5, 12, 40, 64])
def test_filters_spell_and_merge_without_loss(bits):
    rng = np.random.default_rng(bits)
    total = Counter()
    merged = (np.empty(0, np.uint64), np.empty(0, np.int64))
    for n in (1, 3, 200, 5000):
        top = (1 << bits) - 1
        values = rng.integers(0, min(top, 4000) if n > 3 else top, n, dtype=np.uint64, endpoint=True)
        values[:1] = top
        own, counts = exact_dedup._counted(values, rng.integers(1, 2000, n))
        got = exact_dedup.spell(exact_dedup.build(own, counts, bits))
        assert (got[0] == own).all() and (got[1] == counts).all()
        total.update(dict(zip(own.tolist(), counts.tolist())))
        again = [exact_dedup.spell(exact_dedup.build(*merged, bits)) if len(merged[0]) else merged, got]
        merged = exact_dedup._counted(*(np.concatenate([x[k] for x in again]) for k in (0, 1)))
    assert dict(zip(merged[0].tolist(), merged[1].tolist())) == dict(total)


def equal_rows(rows):
    """The contract, row by row: keep, size, digest; of equal keys any row may stay."""
    norm = [re.sub("[\x20\x09-\x0d]+", " ", t or "") for _, t in rows]
    size = Counter(norm)
    least = {}
    for (k, _), n in zip(rows, norm):
        least[n] = min(least.get(n, (True, None)), (k is None, k), key=lambda x: (x[0], x[1] or 0))
    return Counter((k, least[n][1], size[n], sha(n)) for (k, _), n in zip(rows, norm))


@pytest.mark.parametrize("bits, segment, few", [(64, 1 << 18, True), (6, 4, True), (6, 4, False), (64, 4, False)])
def test_exact_groups(spark, bits, segment, few):
    """With six bits most fingerprints agree by chance, so byte verification has to tell the texts apart."""
    random.seed(bits + segment)
    texts = [" ".join(random.choices(["a", "b", " ", "\t", "c\n"], k=random.randint(0, 5))) for _ in range(300)]
    rows = [(i, t) for i, t in enumerate(texts)] + AWKWARD + [(500 + i, "hot  copy") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = exact_dedup.groups(df, "doc_id", "text", bits=bits, segment=segment, broadcast_rows=1 << 20 if few else 0).collect()
    assert Counter((r["key"], r["keep_key"], r["group_size"], r["sha"]) for r in out) == equal_rows(rows)
    kept = Counter(r["sha"] for r in out if r["kept"])
    assert set(kept.values()) == {1} and len(kept) == len({r["sha"] for r in out})
    assert all(r["key"] == r["keep_key"] for r in out if r["kept"])


def test_exact_query_dedup_and_awkward_tables(spark, awkward):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    out = exact_dedup.op11_exact_dedup(spark, SF).collect()
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in out) == equal_rows(rows)
    assert all(r["kept"] == (r["doc_id"] == r["keep_id"]) for r in out)
    left = exact_dedup.dedup(awkward, "doc_id", "text")
    assert left.columns == awkward.columns and all(r["kept"] == "clash" for r in left.collect())
    norms = [re.sub("[\x20\x09-\x0d]+", " ", t or "") for _, t in AWKWARD]
    assert left.count() == len(set(norms))
    assert exact_dedup.dedup(awkward.limit(0), "doc_id", "text").count() == 0


def test_filters_count_a_column(spark):
    prints = spark.range(3000).select((F.col("id") % 700 * 93).alias("fp")).repartition(7)
    merged, high = exact_dedup.filters(prints, 16, 128)
    assert high > 0 and merged.count() > 1
    got = {r["fp"]: r["n"] for r in exact_dedup.repeated(merged, high, 16).collect()}
    assert got == Counter(i % 700 * 93 for i in range(3000))


# --- ranked search

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def ranked(docs, items, top=10):
    terms = [[w.translate(LOWER) for w in TERM.findall(t or "")] for _, t in docs]
    n, total = sum(bool(w) for w in terms), sum(map(len, terms))
    df = Counter(x for w in terms for x in set(w))
    out = Counter()
    for item, t in items:
        asked = Counter(w.translate(LOWER) for w in TERM.findall(t or ""))
        found = []
        for (key, _), words in zip(docs, terms):
            tf = Counter(words)
            score = 0
            for w, q in asked.items():
                if tf[w]:
                    weight = math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1)))
                    score += q * weight * (1_000_000_000 * tf[w] // (1000 * tf[w] + 8 * (100 - 75 + 75 * len(words) * n // total)))
            if score > 0:
                found.append((-score, key is None, key or 0, key))
        for rank, (score, _, _, key) in enumerate(sorted(found)[:top], 1):
            out[item, rank, key, -score] += 1
    return out


@pytest.mark.parametrize("block", [1 << 18, 40, 1])
def test_search_ties_copies_and_blocks(spark, block):
    random.seed(block)
    words = [f"w{i}" for i in range(30)] + ["É", "the", "The", "THE", "a", "42"]
    weights = [1] * 30 + [2, 20, 5, 5, 20, 3]
    docs = [(i, " ".join(random.choices(words, weights, k=random.choice([0, 1, 5, 40])))) for i in range(150)] + AWKWARD
    items = [(i, "-".join(random.choices(words, weights, k=random.choice([0, 1, 3, 20])))) for i in range(25)]
    items += [(None, items[3][1]), (7, items[3][1]), (99, None), (98, "nowhere to be found"), (97, "the " * 50)]
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, score string, item int").repartition(4)
    it = spark.createDataFrame([(*i, "y") for i in items], "item_id long, text string, rank string")
    got = Counter((r["item_id"], r["rank"], r["key"], r["score"]) for r in ranked_search.search(df, "doc_id", "text", it, "item_id", "text", block).collect())
    assert got == ranked(docs, items)


def test_search_query_and_empty_tables(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = Counter(tuple(r) for r in ranked_search.op12_ranked_search(spark, SF).select("item_id", "rank", "doc_id", "score").collect())
    assert got == ranked(docs, items)
    d, i = spark.createDataFrame(docs[:3], "doc_id long, text string"), spark.createDataFrame(items[:3], "item_id long, text string")
    for a, b in ((d.limit(0), i), (d, i.limit(0)), (d.limit(0), i.limit(0))):
        assert ranked_search.search(a, "doc_id", "text", b, "item_id", "text").count() == 0


def test_shared_parts_are_nodes_once(spark):
    """Items that begin alike share nodes, and a set of terms that occurs in the same items is one atom."""
    terms = {0: "the of x y", 1: "the of x z", 2: "the of q", 3: "of"}
    rows = [(i, hash(t) & 0xFFFF, 1, 5) for i, ts in terms.items() for t in ts.split()]
    atoms, nodes = ranked_search.query_graph(spark.createDataFrame(rows, "item long, term long, q long, w long"))
    assert atoms.count() == 6 and atoms.select("atom").distinct().count() == 6
    by = {tuple(sorted(r["items"])): r for r in nodes.collect() if r["items"]}
    shared = sorted((r["depth"], r["n_items"]) for r in nodes.collect() if r["n_items"] > 1)
    assert shared == [(0, 4), (1, 3), (2, 2)] and set(by) == {(0,), (1,), (2,), (3,)}
    assert by[(3,)]["depth"] == 0 and by[(0,)]["depth"] == 3


# --- Merkle manifest

def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def climb(nodes):
    """Levels of a tree, the leaves first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][k : k + 16])) for k in range(0, len(levels[-1]), 16)])
    return levels


def path(levels, at):
    """(left, right) siblings of a leaf on each level."""
    out = []
    for level in levels[:-1]:
        lo = at // 16 * 16
        out.append(("".join(level[lo:at]), "".join(level[at + 1 : lo + 16])))
        at //= 16
    return out


def manifest(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    trees = defaultdict(list)
    for r in rows:
        picked = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
        own = sha("".join(map(field, r)))
        changed = sha("".join(map(field, (*r[:4], r[4] and r[4].translate(LOWER))))) if picked else own
        trees[r[1]].append((r[0] is not None, r[0] or 0, own, changed, r[0]))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    levels = {}
    for s in names:
        trees[s].sort(key=lambda x: x[:3])
        levels[s] = climb([x[2] for x in trees[s]])
    top = climb([levels[s][-1][0] for s in names])
    root = top[-1][0]
    out = Counter()
    for k, s in enumerate(names):
        for at, (_, _, own, changed, key) in enumerate(trees[s]):
            steps = path(levels[s], at) + path(top, k)
            node = changed
            for a, b in steps:
                node = sha(a + node + b)
            out[key, own, levels[s][-1][0], root, sha("".join(a + b for a, b in steps)), node, node == root] += 1
    return out


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"
COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def made(spark, rows, tmp_path, levels=merkle.LEVELS):
    df = spark.createDataFrame([(*r, "clash", 3) for r in rows], SCHEMA + ", leaf string, pos int").repartition(5)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    return Counter(tuple(r) for r in merkle.op13_merkle_manifest(spark, str(tmp_path), levels).select(*COLUMNS).collect())


def test_manifest_of_uneven_trees(spark, tmp_path):
    """One source larger than a superblock, trees of 1, 15, 16, 17, 256 and 257 leaves, a null source, copies, null fields."""
    sizes = {"big": 4096 * 2 + 17, "one": 1, "a": 15, "b": 16, "É": 17, "d": 256, "e": 257, None: 3, "": 2}
    rows, i = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            i += 1
            rows.append((i * 7919 % 100_003, source, None if i % 11 == 0 else "en", None if i % 13 == 0 else i, None if i % 17 == 0 else f"Text É {i}\n"))
    rows += [(None, "a", None, None, None), (None, "a", None, None, None), rows[5], rows[5], (rows[9][0], rows[9][1], "xx", 0, ""), (-5, "a", "en", -1, "ABC")]
    got = made(spark, rows, tmp_path)
    assert got == manifest(rows)
    assert any(not k[-1] for k in got) and any(k[-1] for k in got)


@pytest.mark.parametrize("n", [0, 1, 2, 16, 17])
def test_manifest_of_small_tables(spark, tmp_path, n):
    rows = [(i, "s", "en", 3, "Abc") for i in range(n)]
    assert made(spark, rows, tmp_path) == (manifest(rows) if n else Counter())


def test_manifest_of_deep_trees(spark, tmp_path):
    """With superblocks of 16 nodes the table needs several levels of them, in the sources and above."""
    random.seed(1)
    rows = [(i, f"s{int(random.random() ** 3 * 300):03d}", "en", i, f"T{i}") for i in range(5000)] + [(i, "hot", "en", i, "x") for i in range(5000, 9500)]
    assert made(spark, rows, tmp_path, 1) == manifest(rows)


def test_manifest_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert Counter(tuple(r) for r in merkle.op13_merkle_manifest(spark, SF).select(*COLUMNS).collect()) == manifest(rows)
