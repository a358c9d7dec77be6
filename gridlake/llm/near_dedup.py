"""MinHash near-deduplication: ProbMinHash over weighted shingles, banding, verification.

A text's elements are its shingles of ``SHINGLE`` words (a shorter text is one shingle), weighted by how often they
occur. ProbMinHash: each element is a Poisson process whose rate is its weight; each arrival falls on a random one of
``REGISTERS`` registers, which keeps the earliest arrival and its element. An element stops as soon as its next
arrival is later than all registers' arrivals, so most elements arrive once. The share of registers that two texts
agree on estimates their probability Jaccard similarity.

Texts with equal weighted shingles are one class from the start; all else works on classes. ``BANDS`` bands of ``ROWS``
registers make buckets; a pair of similarity 0.8 shares one with probability 1 - 1e-5. Links are found in two steps:

1. In each bucket one member leads, the one that shares most with others over all buckets (the origin of a group of
   copies, as a rule). The others are compared with it: first by registers (clear misses go), then exactly, on all
   shingles. Groups are the connected components of the links.
2. Buckets that still hold several groups are met in blocks of some ``BLOCK`` members: each two blocks meet in a task of
   their own (but not two of the largest group), which computes the similarities of all pairs of different groups and sends a spanning forest of
   the links. Buckets that share members are met as one, so that a pair is compared once, unless they are many.

So pairs are left out only where both texts are in one group already, and no link between groups is lost.

At scale: copies collapse before anything is joined, step 1 compares each member of a bucket once, step 2 emits as many
rows as a block has members, never all pairs; joins are on keys that adaptive execution may split. Nothing is
gathered to the driver but counts.

Words are runs of digits, letters and characters beyond ASCII, in ASCII lower case. Defined results: texts without
words (null and empty ones too) are alike only if they are equal, null as empty; repeated rows are copies, and one
row of a group is kept (the least doc_id, null last); whole texts are read; an empty table gives an empty result;
carried columns may have any name.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm import _arrays as A
from gridlake.llm._components import components
from gridlake.llm._session import documents, prepare, written
from gridlake.llm.decontaminate import _IS_WORD, _VALUES

SHINGLE = 5
SIMILARITY = 0.8
#: Long bands keep texts that share a passage, but aren't near copies, out of each other's buckets.
BANDS, ROWS = 48, 7
REGISTERS = BANDS * ROWS
#: Registers that a pair is compared by before its shingles are; a smaller share of equal ones than ``CLEAR``, five
#: standard deviations under the similarity, is a clear miss.
COMPARED = 128
CLEAR = SIMILARITY - 5 * (SIMILARITY * (1 - SIMILARITY) / COMPARED) ** 0.5
#: Members and elements of a block on average, and the members of joined buckets beyond which each bucket is met alone.
BLOCK, BLOCK_ELEMENTS = 256, 200_000
JOINED = 1 << 13
_COLUMNS = 1 << 13
_PART_BYTES = 4 << 20


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text and hash of each shingle occurrence."""
    starts, ends, first = A.runs(_IS_WORD, data, offsets)
    values = A.word_hashes(data, starts, ends, _VALUES)
    found = A.window_hashes(values, SHINGLE)
    whole = np.flatnonzero(A.whole_windows(first, len(found), SHINGLE))
    text, hashes = np.searchsorted(first, whole, "right") - 1, found[whole]
    count = np.diff(first)
    short = np.flatnonzero((count > 0) & (count < SHINGLE))
    if len(short):
        own = np.array([A.window_hashes(values[first[t] : first[t + 1]], int(count[t]))[0] for t in short], A.U64)
        text, hashes = np.concatenate([text, short]), np.concatenate([hashes, A.mix(own + count[short].astype(A.U64))])
    return text, hashes


def weighted(text: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct elements of each text, by text and hash, and their weights."""
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(new)
    return text[at], hashes[at], np.diff(np.append(at, len(text)))


def sketch(text: np.ndarray, hashes: np.ndarray, weights: np.ndarray, n: int, registers: int = REGISTERS) -> np.ndarray:
    """ProbMinHash: for each of ``n`` texts and each register, the element that arrives first (0 without elements)."""
    time = np.full((n, registers), np.inf)
    element = np.zeros(n * registers, A.U64)
    flat = time.reshape(-1)
    arrival, w, own = np.zeros(len(text)), weights.astype(float), text.astype(np.int64)
    latest = np.full(n, np.inf)
    turn = 0
    while len(own):
        turn += 1
        draw = A.mix(hashes + A.U64(turn * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        arrival = arrival - np.log(((draw >> A.U64(11)).astype(float) + 0.5) * 2.0**-53) / w
        go = arrival < latest[own]
        own, hashes, w, arrival, draw = own[go], hashes[go], w[go], arrival[go], draw[go]
        # the bits that the arrival doesn't use name the register; unequal shares of registers don't bias a match
        slot = own * registers + ((draw & A.U64(2047)).astype(np.int64) * registers >> 11)
        sooner = np.flatnonzero(arrival < flat[slot])
        s, a = slot[sooner], arrival[sooner]
        np.minimum.at(flat, s, a)
        won = flat[s] == a
        element[s[won]] = hashes[sooner[won]]
        # texts of few elements need many turns: only texts that still have some are looked at
        left = np.unique(own)
        latest[left] = time[left].max(1)
    return element.reshape(n, registers)


_SKETCHED = "n_shingles long, sig0 long, sig1 long, bands array<long>, registers binary"


def _sketches(batches):
    for rows, data, offsets in A.text_blocks(batches, "text", _PART_BYTES):
        n = len(rows)
        parts = [(shingles(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]), lo) for lo, hi in A.blocks(offsets)]
        text, hashes, weights = weighted(np.concatenate([t + lo for (t, _), lo in parts]), np.concatenate([h for (_, h), _ in parts]))
        found = sketch(text, hashes, weights, n)
        count = np.bincount(text, minlength=n)
        first = np.searchsorted(text, np.arange(n))
        sig = []
        for seed in (1, 2):
            own = A.mix(A.mix(hashes + A.U64(seed)) * (A.U64(2) * weights.astype(A.U64) + A.U64(1)))
            sums = np.concatenate([np.zeros(1, A.U64), np.cumsum(own)])
            sig.append(sums[first + count] - sums[first])
        bands = A.mix(found.reshape(n, BANDS, ROWS) * (A.U64(2) * np.arange(ROWS, dtype=A.U64) + A.U64(0x9E3779B97F4A7C15))).sum(2)
        bands = A.mix(bands + np.arange(BANDS, dtype=A.U64))
        sig0, sig1 = sig[0].view(np.int64).tolist(), sig[1].view(np.int64).tolist()
        empty = np.flatnonzero(count == 0)
        for t in empty:  # equal texts only
            digest = hashlib.sha256(data[offsets[t] : offsets[t + 1]].tobytes()).digest()
            sig0[t], sig1[t] = (int.from_bytes(digest[k : k + 8], "little", signed=True) for k in (0, 8))
        lists = [[] if c == 0 else b for c, b in zip(count.tolist(), bands.view(np.int64).tolist())]
        small = (found[:, :COMPARED] >> A.U64(48)).astype(np.uint16)
        cols = [pa.array(count, pa.int64()), pa.array(sig0, pa.int64()), pa.array(sig1, pa.int64()), pa.array(lists, pa.list_(pa.int64())), pa.array([r.tobytes() for r in small], pa.binary())]
        yield pa.RecordBatch.from_arrays([rows.column("row"), rows.column("text"), *cols], ["row", "text", "n_shingles", "sig0", "sig1", "bands", "registers"])


def _elements(batches):
    """Per class: the hashes of its shingles, ascending, and their weights."""
    for rows, data, offsets in A.text_blocks(batches, "text"):
        text, hashes, weights = weighted(*shingles(data, offsets))
        cut = np.searchsorted(text, np.arange(len(rows) + 1))
        both = [(hashes[a:b].tobytes(), weights[a:b].astype(np.int32).tobytes()) for a, b in zip(cut, cut[1:])]
        yield pa.RecordBatch.from_arrays([rows.column("class"), pa.array([x for x, _ in both], pa.binary()), pa.array([y for _, y in both], pa.binary())], ["class", "hashes", "weights"])


def probability_jaccard(ha: np.ndarray, wa: np.ndarray, hb: np.ndarray, wb: np.ndarray) -> float:
    """Exact: over shared elements d, the sum of 1 / sum over all e of max(a(e) / a(d), b(e) / b(d))."""
    both, ia, ib = np.intersect1d(ha, hb, assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    a, b = wa[ia].astype(float), wb[ib].astype(float)
    alone_a, alone_b = float(wa.sum()) - a.sum(), float(wb.sum()) - b.sum()
    ratio = a / b
    kinds, which, count = np.unique(ratio, return_inverse=True, return_counts=True)
    # max(a(e) / a(d), b(e) / b(d)) is the first where e's ratio is at least d's
    sum_a, sum_b = np.bincount(which, a), np.bincount(which, b)
    above_a = np.cumsum(sum_a[::-1])[::-1]
    below_b = np.cumsum(sum_b) - sum_b
    return float((1.0 / ((above_a[which] + alone_a) / a + (below_b[which] + alone_b) / b)).sum())


def _agreement(batches):
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(len(batch), COMPARED) for c in ("ra", "rb"))
        kept = pa.array((a == b).mean(1) >= CLEAR, pa.bool_())
        yield batch.select(["a", "b"]).filter(kept)


def _verified(batches):
    for batch in batches:
        kinds = (("ha", A.U64), ("wa", np.int32), ("hb", A.U64), ("wb", np.int32))
        kept = [probability_jaccard(*(np.frombuffer(batch.column(c)[k].as_buffer(), kind) for c, kind in kinds)) >= SIMILARITY - 1e-12 for k in range(len(batch))]
        yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))


def _masses(left: list[tuple], right: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """For each pair of texts of the two lists, the share of the first one's weight on elements that the second has, and
    the other way round. No similarity is above either of them."""
    sides = []
    for own in (left, right):
        row = np.repeat(np.arange(len(own)), [len(h) for h, _ in own])
        sides.append((row, np.concatenate([h for h, _ in own]), np.concatenate([w / w.sum() for _, w in own]).astype(np.float32)))
    # elements that only one list has are in no pair
    both = np.intersect1d(np.unique(sides[0][1]), np.unique(sides[1][1]), assume_unique=True)
    ab, ba = np.zeros((2, len(left), len(right)), np.float32)
    cells = []
    for row, hashes, share in sides:
        column = np.minimum(np.searchsorted(both, hashes), max(len(both) - 1, 0))
        some = both[column] == hashes if len(both) else np.zeros(len(hashes), bool)
        order = np.argsort(column[some], kind="stable")
        cells.append((row[some][order], column[some][order], share[some][order]))
    for lo in range(0, len(both), _COLUMNS):
        wide = min(_COLUMNS, len(both) - lo)
        parts = []
        for (row, column, share), own in zip(cells, (left, right)):
            at = slice(*np.searchsorted(column, [lo, lo + wide]))
            weight, has = np.zeros((2, len(own), wide), np.float32)
            weight[row[at], column[at] - lo] = share[at]
            has[row[at], column[at] - lo] = 1
            parts.append((weight, has))
        ab += parts[0][0] @ parts[1][1].T
        ba += parts[0][1] @ parts[1][0].T
    return ab, ba


def _met(least: float):
    def run(key, group):
        """A spanning forest of the links between groups, in one block (side 0) or between two (sides 1 and 2)."""
        group = group.combine_chunks().sort_by("class")
        ids, side = group.column("class").to_numpy(), group.column("side").to_numpy()
        _, grp = np.unique(group.column("grp").to_numpy(), return_inverse=True)
        own = [(np.frombuffer(h.as_buffer(), A.U64), np.frombuffer(w.as_buffer(), np.int32)) for h, w in zip(group.column("hashes"), group.column("weights"))]
        # the pairs to be compared: of one block with itself, or of one with the other
        left = np.arange(len(own)) if side.max() == 0 else np.flatnonzero(side == 1)
        right = left if side.max() == 0 else np.flatnonzero(side == 2)
        if not len(left) or not len(right):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        ab, ba = _masses([own[k] for k in left], [own[k] for k in right])
        likely = (np.minimum(ab, ba) >= least - 1e-4) & (grp[left][:, None] != grp[right][None])
        if left is right:
            likely = np.triu(likely, 1)
        # where no element of either text repeats, the similarity is that of sets, and the masses tell it exactly
        single, size = np.array([bool((w == 1).all()) for _, w in own]), np.array([float(len(w)) for _, w in own])
        sets = single[left][:, None] & single[right][None]
        shared = np.rint(ab.astype(float) * size[left][:, None])
        likely &= ~sets | (shared >= (least - 1e-12) * (size[left][:, None] + size[right][None] - shared))
        parent = list(range(int(grp.max()) + 1))

        def top(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        edges = []
        for x, y in zip(*(z.tolist() for z in np.nonzero(likely))):
            known, x, y = sets[x, y], left[x], right[y]
            a, b = top(grp[x]), top(grp[y])
            if a != b and (known or probability_jaccard(*own[x], *own[y]) >= least - 1e-12):
                parent[max(a, b)] = min(a, b)
                edges.append((ids[x], ids[y]))
        return pa.table({"a": pa.array([e[0] for e in edges], pa.int64()), "b": pa.array([e[1] for e in edges], pa.int64())})
    return run


def _open(members: DataFrame, found: DataFrame) -> DataFrame:
    """(bucket, class, grp) of buckets that hold several groups."""
    state = members.join(found, F.col("class") == F.col("node"), "left").select("bucket", "class", F.coalesce("component", "class").alias("grp"))
    several = state.groupBy("bucket").agg(F.min("grp").alias("low"), F.max("grp").alias("high")).filter("low <> high").select("bucket")
    return written(state.join(several, "bucket"), "open")


def links_and_groups(classes: DataFrame) -> DataFrame:
    """(node, component) of classes (class, bands, registers, text) that are linked to another one."""
    members = classes.select("class", F.explode("bands").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = written(members.join(shared, "bucket"), "members")
    score = members.groupBy("class").agg(F.sum("n").alias("score"))
    facts = written(classes.select("class", "registers", "text").join(score.select("class"), "class"), "texts")
    elements = written(facts.select("class", "text").mapInArrow(_elements, "class long, hashes binary, weights binary"), "elements")
    registers = facts.select("class", "registers")

    lead = members.join(score, "class").groupBy("bucket").agg(F.max_by("class", F.struct("score", "class")).alias("leader"))
    pairs = members.join(lead, "bucket").filter("class <> leader").select(F.least("class", "leader").alias("a"), F.greatest("class", "leader").alias("b")).distinct()
    ra, rb = registers.toDF("a", "ra"), registers.toDF("b", "rb")
    likely = written(pairs.join(ra, "a").join(rb, "b").select("a", "b", "ra", "rb").mapInArrow(_agreement, "a long, b long"), "likely")
    ea, eb = elements.toDF("a", "ha", "wa"), elements.toDF("b", "hb", "wb")
    links = written(likely.join(ea, "a").join(eb, "b").select("a", "b", "ha", "wa", "hb", "wb").mapInArrow(_verified, "a long, b long"), "links")
    found = written(components(links), "groups")

    state = _open(members.select("bucket", "class"), found)
    star = state.groupBy("bucket").agg(F.min("class").alias("b")).join(state, "bucket").select(F.col("class").alias("a"), "b")
    weight = elements.select("class", (F.length("hashes") / 8).cast("long").alias("weight"))
    joined = written(components(star).select(F.col("node").alias("class"), "component").join(weight, "class"), "joined")
    sizes = joined.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    units = state.join(joined, "class").join(sizes, "component")
    as_one = units.filter(F.col("size") <= JOINED).select(F.lit(0).alias("kind"), F.col("component").alias("unit"), "class", "grp", "weight").distinct()
    alone = units.filter(F.col("size") > JOINED).select(F.lit(1).alias("kind"), F.col("bucket").alias("unit"), "class", "grp", "weight")
    # members of a unit's largest group need not meet each other: their blocks come after those of the others
    dealt = as_one.union(alone)
    by_group = dealt.groupBy("kind", "unit", "grp").agg(F.count(F.lit(1)).alias("size"), F.sum("weight").alias("elements"))
    main = by_group.groupBy("kind", "unit").agg(
        F.max_by(F.struct("grp", "size", "elements"), F.struct("size", "grp")).alias("main"), F.sum("size").alias("size"), F.sum("elements").alias("elements"))
    blocks = lambda size, elements: F.ceil(F.greatest(size / BLOCK, elements / BLOCK_ELEMENTS)).cast("int")
    main = main.select("kind", "unit", F.col("main.grp").alias("main"), blocks(F.col("main.size"), F.col("main.elements")).alias("n_main"),
                       blocks(F.col("size") - F.col("main.size"), F.col("elements") - F.col("main.elements")).alias("n_other"))
    met = dealt.join(main, ["kind", "unit"]).withColumn("in_main", F.col("grp") == F.col("main"))
    place = F.when(F.col("in_main"), F.col("n_other") + F.pmod(F.xxhash64("class"), F.col("n_main"))).otherwise(F.pmod(F.xxhash64("class"), F.col("n_other")))
    last = F.when(F.col("in_main"), F.col("n_other")).otherwise(F.col("n_other") + F.col("n_main")) - 1
    meets = F.transform(F.sequence(F.lit(0), last), lambda k: F.struct(F.least(F.col("own"), k).alias("lo"), F.greatest(F.col("own"), k).alias("hi")))
    met = met.withColumn("own", place.cast("int")).withColumn("meet", F.explode(meets))
    side = F.when(F.col("meet.lo") == F.col("meet.hi"), 0).when(F.col("own") == F.col("meet.lo"), 1).otherwise(2)
    met = met.select("kind", "unit", F.col("meet.lo").alias("lo"), F.col("meet.hi").alias("hi"), "class", "grp", side.cast("long").alias("side")).join(elements, "class")
    more = met.groupBy("kind", "unit", "lo", "hi").applyInArrow(_met(SIMILARITY), "a long, b long")
    # links of step 1 enter as their groups, so that the second union works on what is new
    stars = found.filter("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    return components(written(stars.union(more), "links"))


def sketched(docs: DataFrame, text: str, carry: list[str]) -> DataFrame:
    """A written table: id, c0, c1 ... (``carry``), text and the sketch of each row."""
    prepare(docs.sparkSession)
    packed = docs.select(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)]).alias("row"), F.col(f"`{text}`").cast("string").alias("text"))
    out = packed.mapInArrow(_sketches, f"row {packed.schema['row'].dataType.simpleString()}, text string, {_SKETCHED}")
    return written(out.select(F.monotonically_increasing_id().alias("id"), "row.*", "text", *[x.split()[0] for x in _SKETCHED.split(", ")]), "sketches")


def groups(table: DataFrame) -> DataFrame:
    """(id, grp) for each row of a table of ``sketched``: rows of equal ``grp`` are near copies of each other, or joined by such."""
    rows = table.select("id", "sig0", "sig1")
    named = rows.groupBy("sig0", "sig1").agg(F.min("id").alias("class"))
    classes = written(named.select("class"), "classes")
    firsts = table.select("id", "bands", "registers", "text").join(classes, F.col("id") == F.col("class"), "left_semi").withColumnRenamed("id", "class")
    found = links_and_groups(firsts)
    whole = rows.join(named, ["sig0", "sig1"]).select("id", "class")
    return whole.join(found, whole["class"] == found["node"], "left").select("id", F.coalesce("component", "class").alias("grp"))


def dedup(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Rows of ``docs`` without near copies: of each group the row with the least ``key`` (null last) stays."""
    others = [c for c in docs.columns if c != text]
    table = sketched(docs, text, others)
    ranked = groups(table).join(table.select("id", F.col(f"c{others.index(key)}").alias("key")), "id")
    first = ranked.groupBy("grp").agg(F.min(F.struct(F.col("key").isNull(), "key", "id")).alias("first"))
    stay = written(first.select(F.col("first.id").alias("id")), "kept")
    kept = table.select("id", "text", *[f"c{i}" for i in range(len(others))]).join(stay, "id", "left_semi")
    return kept.select(*[(F.col("text") if c == text else F.col(f"c{others.index(c)}")).alias(c) for c in docs.columns])


def op5_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Per document: doc_id, class_id (the least doc_id of its group), kept (one row of each group), n_shingles."""
    table = sketched(documents(spark, sf_dir), "text", ["doc_id"])
    found = written(groups(table).join(table.select("id", F.col("c0").alias("doc_id"), "n_shingles"), "id"), "grouped")
    least = found.groupBy("grp").agg(F.min("doc_id").alias("class_id"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "id")).alias("first"))
    return found.join(least, "grp").select("doc_id", "class_id", (F.col("id") == F.col("first.id")).alias("kept"), "n_shingles")
