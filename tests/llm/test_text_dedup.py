"""Decontamination, substring and suffix-array deduplication: against brute force."""
import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from gridlake.llm import _gsaca, decontaminate, substring_dedup, suffix_dedup
from tests.llm.conftest import AWKWARD, SF


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


# --- decontamination

WORD, LOWER = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def contaminated(docs, items, full=13):
    windows = {}
    for i, t in items:
        w = WORD.findall((t or "").translate(LOWER))
        n = min(full, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add("" if i is None else str(i))
    for d, t in docs:
        w = WORD.findall((t or "").translate(LOWER))
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if own := windows.get(tuple(w[k : k + n])):
                    found |= own
                    hit.update(range(k, k + n))
        yield d, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit) and 20 * len(hit) >= len(w)


def test_query_on_whole_tables(spark, texts):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = {tuple(r) for r in decontaminate.op2_decontaminate(spark, SF).collect()}
    assert got == set(contaminated(texts, items))


@pytest.mark.parametrize("least", [0, 3, 10])
def test_short_items_ties_and_copies(spark, least):
    random.seed(least)
    words = ["a", "b", "c", "É", "x9"]
    docs = [(i, " ".join(random.choices(words, k=random.choice([0, 1, 3, 20, 60])))) for i in range(60)] + AWKWARD
    items = [(i, "-".join(random.choices(words, k=n)).upper()) for i, n in enumerate([*range(16), 13, 13, 30] * 2) if n >= least]
    items += [(None, items[-1][1]), (7, None)]
    df, it = spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string")
    got = Counter(map(tuple, decontaminate.find(df, "text", it, "item_id", "text", ["doc_id"]).collect()))
    assert got == Counter(contaminated(docs, items))


def test_empty_tables(spark, awkward):
    items = spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")
    assert decontaminate.find(awkward.limit(0), "text", items, "item_id", "text", ["doc_id"]).count() == 0
    assert decontaminate.find(awkward, "text", items.limit(0), "item_id", "text", ["doc_id"]).filter("contaminated").count() == 0
    left = decontaminate.clean(awkward, "text", items, "item_id", "text")
    assert left.columns == awkward.columns and left.count() == len(AWKWARD) - 3


# --- windows of words

def kept_words(docs, width):
    seen, out = set(), []
    for d, t in sorted(docs, key=lambda x: (x[0] is not None, x[0], x[1] or "")):
        w = re.findall("[^\x20\x09-\x0D]+", t or "")
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            own = tuple(w[k : k + width])
            if own in seen:
                gone[k : k + width] = [True] * width
            seen.add(own)
        out.append((d, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return Counter(out)


def test_substrings_of_the_query(spark, texts):
    got = Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substring_dedup.op8_substring_dedup(spark, SF).collect())
    assert got == kept_words(texts, substring_dedup.WINDOW)


@pytest.mark.parametrize("block_bytes", [100, 1 << 20])
def test_substrings_over_blocks(spark, block_bytes):
    random.seed(2)
    docs = [(i, " ".join(random.choices("abc", k=random.choice([0, 3, 10, 40]))) + random.choice(["", " ", "\n\n"])) for i in range(80)] + AWKWARD
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    out = substring_dedup.dedup(df, "doc_id", "text", ["doc_id"], width=6, block_bytes=block_bytes)
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], sha(r["kept"])) for r in out.collect()) == kept_words(docs, 6)
    assert substring_dedup.dedup(df.limit(0), "doc_id", "text", ["doc_id"]).count() == 0


def test_substrings_carry_columns_of_clashing_names(awkward):
    out = substring_dedup.dedup(awkward, "doc_id", "text", ["doc_id", "source", "lang"])
    assert out.count() == len(AWKWARD) and out.columns == ["doc_id", "source", "lang", "n_words", "n_removed", "kept"]


# --- suffix arrays

def test_suffix_array_is_the_sorted_order():
    random.seed(5)
    for _ in range(2000):
        t = [random.randint(0, random.choice([0, 1, 2, 5])) for _ in range(random.randint(0, 40))]
        assert _gsaca.suffix_array(t) == sorted(range(len(t)), key=lambda i: t[i:])


def kept_bytes(docs, length):
    texts = [(d, (t or "").encode()) for d, t in docs]
    count = Counter(b[i : i + length] for _, b in texts for i in range(len(b) - length + 1))
    out = []
    for d, b in texts:
        steps = np.zeros(len(b) + 1, int)
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                steps[i] += 1
                steps[i + length] -= 1
        gone = np.cumsum(steps)[:-1] > 0
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(gone) else 0
        out.append((d, len(b), int(gone.sum()), spans, sha(np.frombuffer(b, np.uint8)[~gone].tobytes())))
    return Counter(out)


def test_suffixes_of_the_query(spark, texts):
    got = Counter(tuple(r[c] for c in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) for r in suffix_dedup.op10_suffix_dedup(spark, SF).collect())
    assert got == kept_bytes(texts, suffix_dedup.LENGTH)


@pytest.mark.parametrize(("length", "gram", "hot", "block_bytes"), [(24, 6, 4096, 1 << 20), (24, 6, 4096, 300), (40, 32, 3, 400), (16, 4, 0, 500)])
def test_suffixes_over_blocks_and_hot_anchors(spark, length, gram, hot, block_bytes):
    random.seed(length)
    parts = ["".join(random.choices("ab\0é", k=50)) for _ in range(6)]
    docs = []
    for i in range(100):
        text = ""
        for _ in range(random.choice([0, 1, 3, 8])):
            p, x = random.choice(parts), random.randint(0, 40)
            text += random.choice([p, p[x:], p[:x], "a" * x, "".join(random.choices("xyz", k=x))])
        docs.append((i, text))
    docs += AWKWARD
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    out = suffix_dedup.dedup(df, "doc_id", "text", ["doc_id"], length, gram, hot, block_bytes)
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], sha(bytes(r["kept"]))) for r in out.collect()) == kept_bytes(docs, length)


def test_suffixes_of_nothing(spark, awkward):
    assert suffix_dedup.dedup(awkward.limit(0), "doc_id", "text", ["doc_id"]).count() == 0
