"""Suffix-array deduplication: bytes covered by a string of ``LENGTH`` bytes that also starts anywhere else.

1. Contexts. In each window of ``LENGTH`` bytes the least hash of ``GRAM`` bytes is its anchor (the last of equal
   ones). Neighbouring windows with one anchor make a context: the bytes that they cover. Equal windows have their
   anchors at the same place, so a window needs comparison with windows of contexts of the same anchor only, and no
   window lies in two contexts.
2. Counts in Spark, of contexts and of anchors, each sent once a block: one that occurs once, whose anchor occurs in no
   other context, is done; of the others one copy each goes on, or two of one that occurs more often.
3. Suffix arrays. Contexts are dealt out by anchor. A task writes each of its contexts from its anchor on as a sequence
   of numbers (ranks of ``STEP`` bytes each) and sorts the suffixes of all of them by linear grouping (``_gsaca``).
   Neighbours in this order, compared byte by byte, tell for each length which contexts agree on so many bytes from
   the anchor on. A window is repeated if another context agrees on its bytes from the anchor on, and on those before
   (a rolling hash of up to ``LENGTH - GRAM`` bytes). So two copies of a context meet as neighbours; third and further
   copies, which the hash of the whole context tells, have what those two have.
4. Back at the blocks, repeated windows merge into maximal runs, which are cut out.

An anchor with more than ``HOT`` contexts (a passage whose surroundings differ in very many documents) isn't gathered
in one task: the windows of its contexts are counted by their hashes, like contexts in step 2, each once a block.

At scale: a block is packed once and shuffled twice; what else is shuffled is one hash for each context and the bytes
of contexts that step 3 needs. No bucket is hot: copies collapse before each shuffle. A task holds one block, or
the contexts of a bucket. Equal 64-bit hashes of contexts, and of bytes before an anchor, count as equal.

Defined results: a null or empty text has no bytes; one shorter than ``LENGTH`` keeps all; matches never cross rows;
repeated rows are copies, so both lose what they share; an empty table gives an empty result; whole texts are read
(up to 256 MB each); other columns are left out and can't clash.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm import _arrays as A
from gridlake.llm import _blocks as B
from gridlake.llm._gsaca import suffix_array
from gridlake.llm._session import documents, written
from gridlake.llm.substring_dedup import _cuts

LENGTH = 400
GRAM = 32
STEP = 16
HOT = 4096
#: A task's arrays take some 30 bytes for each byte of a block.
BLOCK_BYTES = 4 << 20
_PLACE_BITS = 28


def _minima(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` hashes, the place of the least (by its high bits; the last of equal ones)."""
    n = len(hashes) - width + 1
    low = A.U64((1 << _PLACE_BITS) - 1)
    both = (hashes & ~low) | (low - np.arange(len(hashes), dtype=A.U64))
    padded = np.full(-(-len(both) // width) * width, ~A.U64(0))
    padded[: len(both)] = both
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return (low - (np.minimum(behind[:n], ahead[width - 1 : width - 1 + n]) & low)).astype(np.int64)


def _contexts(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Text, first byte (in the text), number of windows, anchor (from the first byte on), and hashes of anchor and context."""
    grams = A.byte_window_hashes(data, gram)
    n = len(data) - length + 1
    if n <= 0:
        return tuple(np.empty(0, k) for k in (np.int32, np.int64, np.int32, np.int32, A.U64, A.U64))
    place = _minima(grams, length - gram + 1)
    whole = np.flatnonzero(A.whole_windows(offsets, n, length))
    own = place[whole]
    new = np.ones(len(whole), bool)
    new[1:] = (own[1:] != own[:-1]) | (whole[1:] != whole[:-1] + 1)
    at = np.flatnonzero(new)
    first, count = whole[at], np.diff(np.append(at, len(whole)))
    text = np.searchsorted(offsets, first, "right") - 1
    up, down = A._BYTE_POWERS(len(data) + 1)
    sums = np.zeros(len(data) + 1, A.U64)
    np.cumsum(A.BYTE_VALUE[data] * up[:-1], out=sums[1:])
    anchor = own[at] - first  # least hashes are small; mixed once more, they spread over all buckets
    bytes_ = (sums[first + count - 1 + length] - sums[first]) * down[first]
    context = A.mix(A.mix(bytes_) + count.astype(A.U64) * A.U64(A.WORD_BASE) + anchor.astype(A.U64))
    return text.astype(np.int32), first - offsets[text], count.astype(np.int32), anchor.astype(np.int32), A.mix(grams[own[at]]), context


_NAMES = ["text", "first", "count", "at", "anchor", "context"]


def _marks(length: int, gram: int):
    def make(table: pa.Table) -> bytes:
        parts = []
        for lo, data, offsets in B.sub_blocks(table):
            found = _contexts(data, offsets, length, gram)
            parts.append((found[0] + np.int32(lo), *found[1:]))
        cols = [np.concatenate(c) for c in zip(*parts)]
        return B.pack(pa.table({k: c.view(np.int64) if c.dtype == A.U64 else c for k, c in zip(_NAMES, cols)}))
    return make


def _read(marks: bytes) -> dict[str, np.ndarray]:
    table = B.unpack(marks)
    return {k: table.column(k).to_numpy().view(A.U64) if k in ("anchor", "context") else table.column(k).to_numpy() for k in _NAMES}


_SENT = "kind int, bucket int, block long, n int, keys binary, others binary"


def _sent(kind: int, bits: int, block: int, keys: np.ndarray, others: np.ndarray | None):
    """Ascending keys by bucket, with a number for each if there are ``others``."""
    cuts, rows = _cuts(keys, bits), []
    for bucket in range(1 << bits):
        lo, hi = cuts[bucket], cuts[bucket + 1]
        if lo < hi:
            rows.append((kind, bucket, block, hi - lo, B.pack_numbers(keys[lo:hi]), None if others is None else others[lo:hi].tobytes()))
    if rows:
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [x.split()[0] for x in _SENT.split(", ")])


KEYS, ANCHORS = 0, 1


def _anchors_of(marks: dict) -> tuple[np.ndarray, np.ndarray]:
    """Distinct anchors; for each its context if it has one, else 0, and (in the second column) how many."""
    pairs = np.unique(np.stack([marks["anchor"], marks["context"]], 1), axis=0) if len(marks["anchor"]) else np.empty((0, 2), A.U64)
    anchors, first, count = np.unique(pairs[:, 0], return_index=True, return_counts=True)
    only = np.where(count == 1, pairs[first, 1], A.U64(0))
    return anchors, np.stack([only, count.astype(A.U64)], 1)


def _count_contexts(bits: int):
    def run(batches):
        for batch in batches:
            for block, data in zip(batch.column("block").to_pylist(), batch.column("marks")):
                marks = _read(data.as_py())
                yield from _sent(KEYS, bits, block, np.unique(marks["context"]), None)
                yield from _sent(ANCHORS, bits, block, *_anchors_of(marks))
    return run


_ANSWER = "block long, kind int, bucket int, yes binary, also binary"


def _answer(hot: int):
    def run(key, group):
        """For keys: does another block have it, and is this one of the first two blocks that have it? For anchors: are
        there several contexts, and too many?"""
        kind = key[0].as_py()
        group = group.combine_chunks().sort_by("block")
        n = group.column("n").to_numpy().astype(np.int64)
        keys = np.concatenate([B.unpack_numbers(x.as_py(), k) for x, k in zip(group.column("keys"), n.tolist())])
        order = np.argsort(keys, kind="stable")
        ranked = keys[order]
        new = np.ones(len(ranked), bool)
        new[1:] = ranked[1:] != ranked[:-1]
        at = np.flatnonzero(new)
        size = np.diff(np.append(at, len(ranked)))
        yes, also = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
        if kind == KEYS:
            yes[order] = np.repeat(size > 1, size)
            also[order[at]] = True
            also[order[at[size > 1] + 1]] = True
        else:
            others = np.concatenate([np.frombuffer(x.as_py(), A.U64).reshape(-1, 2) for x in group.column("others")])[order]
            only = others[:, 0]
            several = (np.minimum.reduceat(only, at) != np.maximum.reduceat(only, at)) | (np.minimum.reduceat(only, at) == 0)
            yes[order] = np.repeat(several, size)
            also[order] = np.repeat(np.add.reduceat(others[:, 1], at) > hot, size)
        ends = np.cumsum(n)
        cut = [slice(e - k, e) for k, e in zip(n.tolist(), ends.tolist())]
        return pa.table({"block": group.column("block"), "kind": group.column("kind"), "bucket": group.column("bucket"),
                         "yes": pa.array([np.packbits(yes[c]).tobytes() for c in cut], pa.binary()), "also": pa.array([np.packbits(also[c]).tobytes() for c in cut], pa.binary())})
    return run


def _gathered(answers: DataFrame) -> DataFrame:
    return answers.groupBy("block").agg(F.collect_list(F.struct("kind", "bucket", "yes", "also")).alias("answers"))


def _bits_of(answers: list, kind: int, keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """What the answers say about a block's ascending keys."""
    cuts = _cuts(keys, bits)
    out = np.zeros((2, len(keys)), bool)
    for a in answers or []:
        if a["kind"] == kind:
            lo, hi = cuts[a["bucket"]], cuts[a["bucket"] + 1]
            for row, name in enumerate(("yes", "also")):
                out[row, lo:hi] = np.unpackbits(np.frombuffer(a[name], np.uint8), count=hi - lo).astype(bool)
    return out[0], out[1]


def _judged(marks: dict, answers: list, bits: int) -> tuple[np.ndarray, ...]:
    """For each context of a block: a further copy of one that is repeated as a whole, to be compared (a copy of each, two
    of a repeated one), and of a hot anchor."""
    keys, back, count = np.unique(marks["context"], return_inverse=True, return_counts=True)
    elsewhere, leads = _bits_of(answers, KEYS, keys, bits)
    anchors = np.unique(marks["anchor"])
    several, hot = _bits_of(answers, ANCHORS, anchors, bits)
    of = np.searchsorted(anchors, marks["anchor"])
    order = np.argsort(back, kind="stable")
    nth = np.empty(len(back), np.int64)
    nth[order] = np.arange(len(back)) - np.repeat(np.cumsum(count) - count, count)
    repeated = (elsewhere | (count > 1))[back]
    # the second copy comes from the second block, or from this one if no other has it
    copy = leads[back] & ((nth == 0) | ((nth == 1) & ~elsewhere[back]))
    compared = copy & (several[of] | (repeated & ~hot[of]))
    return repeated & (hot[of] | ~compared), compared, hot[of]


def _hot_windows(table: pa.Table, marks: dict, some: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all windows of some contexts, one after another."""
    column = table.column("text")
    out = [np.empty(0, A.U64)]
    for k in some.tolist():
        first, count = int(marks["first"][k]), int(marks["count"][k])
        data = np.frombuffer(column[int(marks["text"][k])].as_buffer(), np.uint8)
        out.append(A.byte_window_hashes(data[first : first + count - 1 + length], length))
    return np.concatenate(out)


_COMPARED = "kind int, bucket int, block long, n int, keys binary, others binary"
CONTEXTS = 2


def _send_contexts(bits: int, length: int):
    def run(batches):
        for batch in batches:
            for block, payload, data, answers in zip(batch.column("block").to_pylist(), batch.column("payload"), batch.column("marks"), batch.column("answers").to_pylist()):
                marks = _read(data.as_py())
                _, compared, hot = _judged(marks, answers, bits)
                if not compared.any():
                    continue
                table = B.unpack(payload.as_py()).combine_chunks()
                # windows of hot anchors are counted by their hashes
                some = np.flatnonzero(compared & hot)
                if len(some):
                    yield from _sent(KEYS, bits, block, np.unique(_hot_windows(table, marks, some, length)), None)
                some = np.flatnonzero(compared & ~hot)
                some = some[np.argsort(marks["anchor"][some], kind="stable")]
                cuts, rows = _cuts(marks["anchor"][some], bits), []
                text, offsets = A.utf8(table.column("text"))
                begin = offsets[marks["text"]] + marks["first"]
                for bucket in range(1 << bits):
                    own = some[cuts[bucket] : cuts[bucket + 1]]
                    if len(own):
                        size = (marks["count"][own] - 1 + length).astype(np.int64)
                        held = b"".join([text[b : b + z].tobytes() for b, z in zip(begin[own].tolist(), size.tolist())])
                        facts = np.stack([own, marks["count"][own].astype(np.int64), marks["at"][own].astype(np.int64)], 1)
                        rows.append((CONTEXTS, bucket, block, len(own), pa.compress(held, codec="zstd", asbytes=True), facts.tobytes()))
                if rows:
                    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [x.split()[0] for x in _COMPARED.split(", ")])
    return run


def repeated_windows(text: np.ndarray, begin: np.ndarray, count: np.ndarray, at: np.ndarray, length: int, step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """Windows of contexts that also occur in another one: the context, and the window's number in it. Contexts are
    parts of ``text``: their first bytes, numbers of windows, and anchors (from the first byte on)."""
    m = len(begin)
    size = count.astype(np.int64) - 1 + length
    tail = size - at  # bytes from the anchor on
    # ranks of blocks of bytes from the anchor on; a shorter last block is less than a longer equal one
    blocks = -(-tail // step)
    owner = np.repeat(np.arange(m), blocks)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    left = np.minimum(step, tail[owner] - nth * step)
    source = (begin + at)[owner] + nth * step
    padded = np.concatenate([text, np.zeros(step, np.uint8)])
    cells = padded[source[:, None] + np.arange(step)]
    cells[np.arange(step) >= left[:, None]] = 0
    keys = [left, *[np.ascontiguousarray(cells[:, k : k + 8]).view(">u8").ravel() for k in range(step - 8, -1, -8)]]
    order = np.lexsort(keys)
    new = np.ones(len(order), bool)
    new[1:] = np.any([k[order[1:]] != k[order[:-1]] for k in keys], axis=0)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new)
    # the string: all sequences, each closed by 0
    spots = np.arange(len(owner)) + owner
    string = np.zeros(len(owner) + m, np.int64)
    string[spots] = rank
    heads = np.concatenate([[0], np.cumsum(blocks + 1)[:-1]])
    order = np.array(suffix_array(string.tolist()), np.int64)
    is_head = np.full(len(string), -1)
    is_head[heads] = np.arange(m)
    sorted_ = is_head[order]
    sorted_ = sorted_[sorted_ >= 0]
    # bytes that neighbours agree on, ``length`` at most
    agree = np.zeros(m + 1, np.int64)
    for lo in range(1, m, 4096):
        a, b = sorted_[lo - 1 : min(lo + 4095, m - 1)], sorted_[lo : min(lo + 4096, m)]
        both = np.minimum(np.minimum(tail[a], tail[b]), length)
        cols = np.arange(length)
        longer = np.concatenate([text, np.zeros(length, np.uint8)])
        x, y = longer[(begin + at)[a][:, None] + cols], longer[(begin + at)[b][:, None] + cols]
        same = (x == y) & (cols < both[:, None])
        agree[lo : lo + len(a)] = np.where(same.all(1), length, np.argmin(same, axis=1))
    near = np.empty(m, np.int64)  # the most that a context agrees on with any other one
    near[sorted_] = np.maximum(agree[:-1], agree[1:])
    rank_of = np.empty(m, np.int64)
    rank_of[sorted_] = np.arange(m)
    up, down = A._BYTE_POWERS(len(text) + 1)
    sums = np.zeros(len(text) + 1, A.U64)
    np.cumsum(A.BYTE_VALUE[text] * up[:-1], out=sums[1:])
    found_context, found_window, found_key = [], [], []
    # windows by how many bytes lie before the anchor; those with ``need`` bytes from the anchor on
    for before in range(int(at.max(initial=-1)) + 1):
        need = length - before
        window = at - before
        here = np.flatnonzero((window >= 0) & (window < count) & (near >= need))
        if len(here) > 1:
            kind = np.cumsum(agree[:-1] < need)[rank_of[here]]
            lead = (begin + at)[here]
            prefix = (sums[lead] - sums[lead - before]) * down[lead - before]
            found_context.append(here)
            found_window.append(window[here])
            found_key.append(A.mix(A.mix(prefix + A.U64(before)) ^ A.mix(kind.astype(A.U64) * A.U64(A.WORD_BASE) + A.U64(need))))
    if not found_key:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    context, window, key = (np.concatenate(x) for x in (found_context, found_window, found_key))
    order = np.argsort(key)
    twice = np.zeros(len(order), bool)
    same = key[order[1:]] == key[order[:-1]]
    twice[1:] |= same
    twice[:-1] |= same
    hit = order[twice]
    return context[hit], window[hit]


def _compare(length: int, hot: int):
    answer = _answer(hot)

    def run(key, group):
        """Windows of a bucket's contexts that another context has too, as bits of all windows that a block has sent."""
        if key[0].as_py() == KEYS:
            return answer(key, group)
        group = group.combine_chunks().sort_by("block")
        facts = [np.frombuffer(x.as_py(), np.int64).reshape(-1, 3) for x in group.column("others")]
        count, at = np.concatenate([f[:, 1] for f in facts]), np.concatenate([f[:, 2] for f in facts])
        size = count - 1 + length
        totals = [int((f[:, 1] - 1 + length).sum()) for f in facts]
        text = np.frombuffer(b"".join([pa.decompress(x.as_py(), n, codec="zstd", asbytes=True) for x, n in zip(group.column("keys"), totals)]), np.uint8)
        begin = np.cumsum(size) - size
        context, window = repeated_windows(text, begin, count, at, length)
        base = np.cumsum(count) - count
        flags = np.zeros(int(count.sum()), bool)
        flags[base[context] + window] = True
        ends = np.cumsum([int(f[:, 1].sum()) for f in facts])
        starts = ends - np.array([int(f[:, 1].sum()) for f in facts])
        yes = [np.packbits(flags[a:b]).tobytes() for a, b in zip(starts.tolist(), ends.tolist())]
        also = [f[:, 0].tobytes() for f in facts]
        return pa.table({"block": group.column("block"), "kind": group.column("kind"), "bucket": group.column("bucket"), "yes": pa.array(yes, pa.binary()), "also": pa.array(also, pa.binary())})
    return run


def _removed(n_carry: int, bits: int, length: int):
    names = [*[f"c{i}" for i in range(n_carry)], "n_bytes", "n_removed", "n_spans", "kept"]

    def run(batches):
        for batch in batches:
            cols = [batch.column(c) for c in ("payload", "marks")]
            for payload, data, answers, found in zip(*cols, batch.column("answers").to_pylist(), batch.column("found").to_pylist()):
                table, marks = B.unpack(payload.as_py()).combine_chunks(), _read(data.as_py())
                further, compared, hot = _judged(marks, answers, bits)
                text, offsets = A.utf8(table.column("text"))
                begin = offsets[marks["text"]] + marks["first"]
                count = marks["count"].astype(np.int64)
                # differences of how many repeated windows cover a byte
                steps = np.zeros(len(text) + 1, np.int32)
                np.add.at(steps, begin[further], 1)
                np.add.at(steps, begin[further] + count[further] - 1 + length, -1)
                hits = [np.empty(0, np.int64)]
                for a in found or []:
                    if a["kind"] == CONTEXTS:
                        own = np.frombuffer(a["also"], np.int64)
                        n = count[own]
                        flags = np.unpackbits(np.frombuffer(a["yes"], np.uint8), count=int(n.sum())).astype(bool)
                        places = np.repeat(begin[own] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                        hits.append(places[flags])
                some = np.flatnonzero(compared & hot)
                if len(some):
                    hashes = _hot_windows(table, marks, some, length)
                    keys, back, times = np.unique(hashes, return_inverse=True, return_counts=True)
                    elsewhere, _ = _bits_of(found, KEYS, keys, bits)
                    n = count[some]
                    places = np.repeat(begin[some] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                    hits.append(places[(elsewhere | (times > 1))[back]])
                hit = np.concatenate(hits)
                np.add.at(steps, hit, 1)
                np.add.at(steps, hit + length, -1)
                gone = np.cumsum(steps[:-1], dtype=np.int32) > 0
                del steps, hit, hits
                opens = gone.copy()
                inner = offsets[(offsets > 0) & (offsets < len(text))]
                opens[1:] &= ~gone[:-1]
                opens[inner] = gone[inner]
                sums, spans = (np.concatenate([[0], np.cumsum(x, dtype=np.int32)]).astype(np.int32) for x in (gone, opens))
                for at in range(0, len(table), 512):
                    rows = table.slice(at, 512)
                    lo, hi = offsets[at : at + len(rows)], offsets[at + 1 : at + len(rows) + 1]
                    kept = [text[a:b][~gone[a:b]].tobytes() for a, b in zip(lo.tolist(), hi.tolist())]
                    made = [pa.array(hi - lo, pa.int64()), pa.array(sums[hi] - sums[lo], pa.int64()), pa.array(spans[hi] - spans[lo], pa.int64()), pa.array(kept, pa.binary())]
                    yield pa.RecordBatch.from_arrays([*[rows.column(f"c{i}").combine_chunks() for i in range(n_carry)], *made], names)
    return run


def dedup(docs: DataFrame, order: str, text: str, carry: list[str], length: int = LENGTH, gram: int = GRAM, hot: int = HOT, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``carry`` columns of ``docs``, n_bytes, n_removed, n_spans and the bytes that are kept."""
    table = B.blocks(docs, order, text, carry, block_bytes, _marks(length, gram))
    bits = B.bucket_bits(table.count())
    sent = table.select("block", "marks").mapInArrow(_count_contexts(bits), _SENT)
    answers = written(_gathered(sent.groupBy("kind", "bucket").applyInArrow(_answer(hot), _ANSWER)), "answers")
    judged = table.select("block", "payload", "marks").join(answers, "block", "left")
    compared = judged.mapInArrow(_send_contexts(bits, length), _COMPARED).groupBy("kind", "bucket").applyInArrow(_compare(length, hot), _ANSWER)
    found = _gathered(compared).withColumnRenamed("answers", "found")
    both = judged.join(found, "block", "left").select("payload", "marks", "answers", "found")
    fields = ", ".join([*[f"c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(carry)], "n_bytes long, n_removed long, n_spans long, kept binary"])
    out = both.mapInArrow(_removed(len(carry), bits, length), fields)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)], "n_bytes", "n_removed", "n_spans", "kept")


def op10_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    out = dedup(documents(spark, sf_dir), "doc_id", "text", ["doc_id"])
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
