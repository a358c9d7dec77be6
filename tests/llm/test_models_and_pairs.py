"""BPE, toxicity, near copies of texts and of vectors, the pipeline: round trips, held-out accuracy, brute force."""
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gridlake.llm import _components, bpe, embedding_dedup, near_dedup, toxicity
from tests.llm.conftest import AWKWARD, SF


# --- BPE

@pytest.fixture(scope="module")
def codec():
    return bpe.default_codec()


@pytest.fixture(scope="module")
def library(codec):
    tiktoken = pytest.importorskip("tiktoken")
    return tiktoken.Encoding("own", pat_str=codec.pattern, mergeable_ranks=codec.ranks, special_tokens={})


def test_tree_reduction_equals_the_library(codec, library, monkeypatch):
    monkeypatch.setattr(bpe, "LEAF_CHARS", 16)
    monkeypatch.setattr(bpe, "LEAF_BYTES", 4)
    random.seed(3)
    parts = ["a", "b", " ", "  ", "\n", "'", "'re", "'ll", "s", "é", "漢", "😀", "1", "23", "!", "?!", "\t", "aaaa", "      ", "=", "the", "ing", "　", "İ", "<|endoftext|>"]
    for _ in range(1500):
        text = "".join(random.choices(random.sample(parts, random.randint(1, 8)), k=random.randint(0, 120)))
        codec.memo.clear()
        assert codec.encode(text) == library.encode_ordinary(text)


def test_texts_of_the_tables_are_joined(texts, codec, library, monkeypatch):
    joins = Counter()
    for name in ("_join", "_join_cuts"):
        def counted(self, *args, name=name, own=getattr(bpe.Codec, name)):
            joins[name] += 1
            return own(self, *args)
        monkeypatch.setattr(bpe.Codec, name, counted)
    codec.memo.clear()
    assert all(codec.encode(t) == library.encode_ordinary(t or "") for _, t in texts)
    assert joins["_join"] > 100 and joins["_join_cuts"] > 100


def test_long_texts(codec, library):
    for text in ("=" * 20_000 + "x", "ab " * 60_000, " " * 5000 + "end", "ß" * 9000):
        ids = codec.encode(text)
        assert ids == library.encode_ordinary(text) and codec.decode(ids) == text.encode()


def test_query_equals_the_library(spark, texts, library):
    import hashlib

    def row(i, t):
        ids = library.encode_ordinary(t or "")
        return i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()
    assert {tuple(r) for r in bpe.op3_byte_bpe(spark, SF).collect()} == {row(*x) for x in texts}


def test_round_trip_of_awkward_rows(awkward, codec):
    out = bpe.decode(bpe.encode(awkward, "text", codec), "ids", codec)
    rows = out.select("text", "decoded", "n_tokens", "kept").collect()
    assert len(rows) == len(AWKWARD) and all(bytes(r["decoded"]) == (r["text"] or "").encode() and r["kept"] == "clash" for r in rows)
    assert bpe.encode(awkward.limit(0), "text", codec).count() == 0


# --- toxicity

def test_held_out_accuracy(spark):
    sf = SF.replace("0.001", "0.1")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = toxicity.op4_toxicity(spark, sf).join(labels, "doc_id").filter("held_out").select("score", "toxic", "predicted").collect()
    score, toxic = np.array([r["score"] for r in rows]), np.array([r["toxic"] for r in rows])
    above = (score[toxic == 1][:, None] > score[toxic == 0]).mean() + (score[toxic == 1][:, None] == score[toxic == 0]).mean() / 2
    predicted = np.array([r["predicted"] for r in rows])
    assert above > 0.97 and (toxic[predicted == 1] == 1).mean() > 0.9


def test_held_out_rows_are_not_learnt_from(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.train(docs, labels), toxicity.train(docs, flipped)
    assert np.array_equal(a.grams, b.grams) and np.array_equal(a.weights, b.weights) and a.constant == b.constant


def test_scores_of_awkward_rows(spark, awkward):
    labels = spark.createDataFrame([(4, 1, 0), (5, 1, None), (6, 0, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for marks in (labels, labels.limit(0)):
        out = toxicity.score(awkward, toxicity.train(awkward, marks), awkward.columns, "own_score")
        rows = out.collect()
        assert out.columns == [*awkward.columns, "own_score"] and len(rows) == len(AWKWARD)
        assert all(0 <= r["own_score"] <= 1 for r in rows)
        assert toxicity.score(awkward.limit(0), toxicity.train(awkward.limit(0), marks), ["doc_id"]).count() == 0


# --- near copies of texts

WORD, LOWER = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [("raw", text or "")])


def similarity(a, b):
    every = set(a) | set(b)
    return sum(1 / sum(max(a.get(e, 0) / a[d], b.get(e, 0) / b[d]) for e in every) for d in a if d in b)


def groups_of(docs):
    own, parent = [shingles(t) for _, t in docs], list(range(len(docs)))

    def top(x):
        return x if parent[x] == x else top(parent[x])
    where = {}
    for k, s in enumerate(own):
        for g in s:
            where.setdefault(g, []).append(k)
    for a, b in {(a, b) for ks in where.values() for a in ks for b in ks if a < b}:
        if top(a) != top(b) and similarity(own[a], own[b]) >= near_dedup.SIMILARITY - 1e-12:
            parent[max(top(a), top(b))] = min(top(a), top(b))
    return [top(k) for k in range(len(docs))]


def partition(keys, groups):
    by = {}
    for k, g in zip(keys, groups):
        by.setdefault(g, []).append(k)
    return sorted(map(sorted, by.values()))


def test_groups_of_the_query(spark, texts):
    rows = near_dedup.op5_near_dedup(spark, SF).collect()
    assert partition([r["doc_id"] for r in rows], [r["class_id"] for r in rows]) == partition([i for i, _ in texts], groups_of(texts))
    assert all((r["doc_id"] == r["class_id"]) == r["kept"] for r in rows)


def test_chains_copies_and_passages(spark):
    random.seed(8)
    words = [f"w{k}" for k in range(4000)]
    base = random.choices(words, k=200)
    docs, own = [], list(base)
    for i in range(40):  # a chain: neighbours are near, the ends are not
        own = [random.choice(words) if k in (5 * i % 200, (5 * i + 100) % 200) else x for k, x in enumerate(own)]
        docs.append((i, " ".join(own)))
    passage = random.choices(words, k=60)
    docs += [(100 + i, " ".join(random.choices(words, k=60) + passage)) for i in range(60)]  # a shared passage, not near
    docs += [(200 + i, " ".join(base).upper()) for i in range(30)]
    docs += [(300 + i, " ".join(random.choices("ab", k=n))) for i, n in enumerate([1, 2, 3, 4, 5, 6, 30, 60])]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    out = near_dedup.dedup(df, "doc_id", "text").select("doc_id").collect()
    groups = groups_of(docs)
    least = {}
    for (i, _), g in zip(docs, groups):
        least[g] = min(i, least.get(g, i))
    assert sorted(r["doc_id"] for r in out) == sorted(least.values())


def test_exact_probability_jaccard():
    random.seed(1)
    for _ in range(300):
        a, b = (Counter(random.choices(range(8), k=random.randint(1, 12))) for _ in "ab")
        arrays = [(np.array(sorted(x), np.uint64), np.array([x[k] for k in sorted(x)], np.int32)) for x in (a, b)]
        assert near_dedup.probability_jaccard(*arrays[0], *arrays[1]) == pytest.approx(similarity(a, b))


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(0)
    a = rng.integers(1, 1 << 62, 400).astype(np.uint64)
    b = np.concatenate([a[:350], rng.integers(1, 1 << 62, 50).astype(np.uint64)])
    text = np.repeat([0, 1], 400)
    found = near_dedup.sketch(text, np.concatenate([a, b]), np.ones(800, np.int64), 2, 2048)
    assert (found[0] == found[1]).mean() == pytest.approx(350 / 450, abs=0.05)


def test_near_dedup_of_awkward_rows(awkward):
    out = near_dedup.dedup(awkward, "doc_id", "text")
    rows = out.collect()
    assert out.columns == awkward.columns
    # null and "" are one; one and One; the copies of a b c ...; the two long repeats; the x's
    assert sorted((r["doc_id"], r["text"]) for r in rows) == [(1, None), (3, "   \n\t "), (4, "one"), (6, "a b c d e f g"), (7, AWKWARD[9][1]), (8, "word " * 4000), (10, "x" * 3000)]
    assert near_dedup.dedup(awkward.limit(0), "doc_id", "text").count() == 0


def test_components(spark):
    path = [(k, k + 1) for k in range(50)] + [(100, 101), (102, 101), (7, 7)]
    got = dict(map(tuple, _components.components(spark.createDataFrame(path, "a long, b long")).collect()))
    assert got == {**{k: 0 for k in range(51)}, 100: 100, 101: 100, 102: 100}
    assert _components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- vectors

def links_of(vectors, least=0.9):
    unit = []
    for v in vectors:
        ok = bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        unit.append(np.array(v, float) / np.linalg.norm(v) if ok else None)
    n, parent = len(unit), list(range(len(unit)))

    def top(x):
        return x if parent[x] == x else top(parent[x])
    links = [0] * n
    for a in range(n):
        for b in range(a):
            if unit[a] is not None and unit[b] is not None and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= least:
                links[a] += 1
                links[b] += 1
                parent[max(top(a), top(b))] = min(top(a), top(b))
    return links, [top(k) for k in range(n)]


@pytest.mark.parametrize("leaf", [1024, 16])
def test_vectors_against_brute_force(spark, leaf):
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(12, 16))
    vectors = [list(map(float, c + rng.normal(size=16) * s)) for c in centre for s in (0.1, 0.15, 0.3, 0.6) for _ in range(6)]
    vectors += [vectors[0]] * 40 + [None, [], [0.0] * 16, [float("nan")] * 16, [None] * 16, [1.0] * 3, [2.0] * 3, [1e-200] * 3, [1e200] * 3]
    df = spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, label int").repartition(3)
    got = {r["vec_id"]: r for r in embedding_dedup.dedup(df, "vec_id", "embedding", leaf=leaf, trees=16).collect()}
    with np.errstate(over="ignore"):
        plain = [v if not v or len(v) != 3 else [1.0] * 3 for v in vectors]
        links, group = links_of(plain)
    found = sum(r["n_links"] for r in got.values())
    assert found >= 0.98 * sum(links) and all(got[i]["n_links"] <= n for i, n in enumerate(links))
    if leaf > len(vectors):
        assert [got[i]["n_links"] for i in range(len(links))] == links
        assert [got[i]["component_id"] for i in range(len(links))] == group
    assert embedding_dedup.dedup(df.limit(0), "vec_id", "embedding").count() == 0


def many_links_of(vectors, least=0.9):
    unit = np.array(vectors, float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    return np.concatenate([(unit[at : at + 512] @ unit.T >= least).sum(1) - 1 for at in range(0, len(unit), 512)])


def planted(rng, spread, dense, others, size):
    """One dense group around a centre, and small groups of near vectors."""
    def around(centre, n):
        x = rng.normal(size=(n, size))
        return centre + spread * x / np.linalg.norm(x, axis=1, keepdims=True)
    centres = rng.normal(size=(others // 4, size))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    rows = [around(centres[0], dense), *[around(c, 4) for c in centres]]
    return np.concatenate(rows).astype(np.float32)


def found_links(spark, vectors):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(vectors.tolist())], "vec_id long, embedding array<float>").repartition(8)
    rows = embedding_dedup.dedup(frame, "vec_id", "embedding").select("vec_id", "n_links").collect()
    return np.array([n for _, n in sorted(map(tuple, rows))])


@pytest.mark.parametrize("spread", [0.3, 0.36])
def test_links_of_a_dense_group_larger_than_leaves(spark, spread):
    """With the defaults, on several leaves besides; at 0.36 only a part of the group's pairs link."""
    vectors = planted(np.random.default_rng(5), spread, 3 * embedding_dedup.LEAF, 6000, 64)
    links, got = many_links_of(vectors), found_links(spark, vectors)
    assert (got <= links).all() and got.sum() >= 0.98 * links.sum()


def test_vectors_of_clashing_columns_and_joined_leaves(spark, monkeypatch):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(40, 12))
    vectors = np.repeat(base, 6, 0) + 0.1 * rng.normal(size=(240, 12))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    names = ("id", "row", "key", "v", "unit", "raw", "copies", "leaf", "leaves", "node", "n_links", "component_id", "kept")
    wide = frame.select("*", *[F.lit("x").alias(c) for c in names])
    wanted = {tuple(r) for r in embedding_dedup.dedup(frame, "vec_id", "embedding", leaf=16).collect()}
    assert any(r[1] for r in wanted)
    # large leaves beyond the bound of the broadcast are joined
    monkeypatch.setattr(embedding_dedup, "BROADCAST_LEAVES", -1)
    out = embedding_dedup.dedup(wide, "vec_id", "embedding", leaf=16)
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"] and {tuple(r) for r in out.collect()} == wanted


def test_vectors_of_many_lengths(spark):
    rows = [(2 * n + k, [1.0] * (n - 1) + [1.0 + k / 100]) for n in range(2, 1202) for k in range(2)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(8)
    got = {tuple(r) for r in embedding_dedup.dedup(frame, "vec_id", "embedding").collect()}
    assert got == {(i, 1, i - i % 2, i % 2 == 0) for i, _ in rows}


# --- pipeline

def test_pipeline_stages(spark, awkward):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "minhash near-dedup", "benchmark decontamination", "secret scan", "byte-level bpe"]
    out = corpus_pipeline.run(spark, SF)
    assert 0 < out.count() < docs.count()
    extra = awkward.withColumn("doc_id", F.col("doc_id"))
    for name, stage in corpus_pipeline.STAGES:
        for own in (extra, extra.limit(0)):
            made = stage(spark, own, SF)
            rows = made.count()
            assert rows <= own.count()
            if name != "byte-level bpe":
                assert made.columns == own.columns


def test_stages_keep_clean_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    scores = toxicity.score(docs, toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet")), ["doc_id"]).filter("score < 0.3").count()
    assert stages["toxicity"](spark, docs, SF).count() == scores
    assert stages["minhash near-dedup"](spark, docs, SF).count() == near_dedup.op5_near_dedup(spark, SF).filter("kept").count()
    assert stages["secret scan"](spark, docs, SF).filter("text not like '%<secret>%'").exceptAll(docs).count() == 0
