"""Substring deduplication: Rabin-Karp hashes of every window of ``WINDOW`` words, counted in Spark.

Documents are dealt into blocks (see ``_blocks``). For each block a task hashes all windows, keeps each hash once, with
the first document of the block that holds it, and sends the hashes on in sorted, packed buckets. A bucket gathers the
hashes of one range from all blocks and finds which block has the first occurrence of each; its answer to a block is
one bit for each hash: does the window start earlier elsewhere? Back at the block, windows are hashed again, and a
window goes if its bit is set or if it isn't the first of its kind in the block; the words that such windows cover
merge into maximal intervals, which are cut out.

At scale: a window that occurs a million times in a block is one hash, so common passages and groups of copies are
counted before the shuffle and no bucket is hot. What is shuffled is about 6 bytes a window, and the packed texts once.
A task holds one block, or one bucket of about as many hashes. Nothing is gathered to the driver but the number of
blocks. Equal 64-bit hashes count as equal windows; with n windows, n * n / 2 ** 65 pairs of unequal ones are expected.

Order: by ``doc_id``, null first. Rows that share a doc_id are taken one after another in a fixed order, so of
repeated rows the first keeps its words. Defined results: a null or empty text, or one of blanks, has no words and
nothing to remove; a text with fewer words than a window loses none; whole texts are read, however long; an empty
table gives an empty result; other columns are left out and can't clash.
"""
from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm import _arrays as A
from gridlake.llm import _blocks as B
from gridlake.llm._session import documents

WINDOW = 20

#: Words are runs of bytes other than blanks: ``[^\x20\x09-\x0D]+``.
_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, 9, 10, 11, 12, 13]] = False


def _windows(table: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a block: hashes of its windows, their texts, their first words (in the text), words of each text."""
    hashes, texts, places, n_words = [], [], [], []
    for lo, data, offsets in B.sub_blocks(table):
        starts, ends, first = A.runs(_IS_WORD, data, offsets)
        values = A.word_hashes(data, starts, ends)
        found = A.window_hashes(values, width)
        whole = np.flatnonzero(A.whole_windows(first, len(found), width))
        text = np.searchsorted(first, whole, "right") - 1
        hashes.append(found[whole])
        texts.append((text + lo).astype(np.int32))
        places.append((whole - first[text]).astype(np.int32))
        n_words.append(np.diff(first))
    join = lambda parts, kind: np.concatenate(parts) if parts else np.empty(0, kind)
    return join(hashes, A.U64), join(texts, np.int32), join(places, np.int32), join(n_words, np.int64)


def _first(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes, ascending; the first window of each; for each window, which distinct hash it has."""
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    new = np.ones(len(ranked), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    back = np.empty(len(ranked), np.int64)
    back[order] = np.cumsum(new) - 1
    return ranked[new], order[new], back


def _cuts(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Where the buckets of ascending hashes begin (and the end)."""
    edges = np.arange(1, 1 << bits, dtype=A.U64) << A.U64(64 - bits)
    return np.concatenate([[0], np.searchsorted(hashes, edges), [len(hashes)]])


def _send(width: int, bits: int):
    def run(batches):
        for batch in batches:
            for block, payload in zip(batch.column("block").to_pylist(), batch.column("payload")):
                table = B.unpack(payload.as_py())
                hashes, texts, _, _ = _windows(table, width)
                distinct, first, _ = _first(hashes)
                ids = table.column("order").to_numpy()
                owner, cuts = texts[first], _cuts(distinct, bits)
                rows = []
                for bucket in range(1 << bits):
                    here = slice(cuts[bucket], cuts[bucket + 1])
                    if here.start < here.stop:
                        # the documents of a bucket: their ids once, and a number for each hash
                        held, number = np.unique(owner[here], return_inverse=True)
                        low = np.stack([number & 255, number >> 8 & 255, number >> 16]).astype(np.uint8)
                        rows.append((bucket, block, here.stop - here.start, len(held), B.pack_numbers(distinct[here]),
                                     B.pack_numbers(ids[held].view(np.uint64)), pa.compress(low.tobytes(), codec="zstd", asbytes=True)))
                        if len(rows) == 64:
                            yield _rows(rows)
                            rows = []
                if rows:
                    yield _rows(rows)
    return run


_SENT = "bucket int, block long, n int, n_ids int, hashes binary, ids binary, owners binary"


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [x.split()[0] for x in _SENT.split(", ")])


def _answer(group: pa.Table) -> pa.Table:
    """For one bucket: per block, a bit for each hash that starts earlier in another block."""
    group = group.take(pa.compute.sort_indices(group, [("block", "ascending")]))
    n = group.column("n").to_numpy()
    hashes, owners = [], []
    for k, (size, n_ids) in enumerate(zip(n.tolist(), group.column("n_ids").to_pylist())):
        hashes.append(B.unpack_numbers(group.column("hashes")[k].as_py(), size))
        ids = B.unpack_numbers(group.column("ids")[k].as_py(), n_ids).view(np.int64)
        low = np.frombuffer(pa.decompress(group.column("owners")[k].as_py(), 3 * size, codec="zstd"), np.uint8).reshape(3, size).astype(np.int64)
        owners.append(ids[low[0] | low[1] << 8 | low[2] << 16])
    hashes, owners = np.concatenate(hashes), np.concatenate(owners)
    order = np.argsort(hashes, kind="stable")  # equal hashes stay in the order of their blocks
    ranked = hashes[order]
    same = ranked[1:] == ranked[:-1]
    later = np.zeros(len(hashes), bool)
    if same.any():
        repeated = np.zeros(len(ranked), bool)
        repeated[1:] |= same
        repeated[:-1] |= same
        some = order[repeated]
        some = some[np.lexsort((some, owners[some], hashes[some]))]
        later[some[1:]] = hashes[some[1:]] == hashes[some[:-1]]
    ends = np.cumsum(n)
    bits = [np.packbits(later[e - k : e]).tobytes() if later[e - k : e].any() else b"" for k, e in zip(n.tolist(), ends.tolist())]
    out = pa.table({"block": group.column("block"), "bucket": group.column("bucket"), "bits": pa.array(bits, pa.binary())})
    return out.filter(pa.array([bool(b) for b in bits], pa.bool_()))


def _kept(width: int, bits: int, carry_type: list[pa.DataType]):
    def run(batches):
        for batch in batches:
            for payload, answers in zip(batch.column("payload"), batch.column("answers").to_pylist()):
                table = B.unpack(payload.as_py())
                hashes, texts, places, n_words = _windows(table, width)
                distinct, first, back = _first(hashes)
                cuts, later = _cuts(distinct, bits), np.zeros(len(distinct), bool)
                for a in answers or []:
                    lo, hi = cuts[a["bucket"]], cuts[a["bucket"] + 1]
                    later[lo:hi] = np.unpackbits(np.frombuffer(a["bits"], np.uint8), count=hi - lo).astype(bool)
                gone = later[back] if len(back) else np.empty(0, bool)
                again = np.ones(len(hashes), bool)
                again[first] = False
                gone |= again
                # words that a window covers: differences at its first word and behind its last one
                base = np.concatenate([[0], np.cumsum(n_words)])
                begin = base[texts[gone]] + places[gone]
                steps = np.bincount(begin, minlength=base[-1] + 1) - np.bincount(begin + width, minlength=base[-1] + 1)
                covered = np.cumsum(steps) > 0
                removed = np.concatenate([[0], np.cumsum(covered)])
                for at in range(0, len(table), 512):
                    rows = table.slice(at, 512)
                    kept, n_removed = [], []
                    for k, text in enumerate(rows.column("text").to_pylist(), at):
                        lo, hi = base[k], base[k + 1]
                        words = text.encode().split()
                        n_removed.append(int(removed[hi] - removed[lo]))
                        if n_removed[-1]:
                            words = itertools.compress(words, (~covered[lo:hi]).tolist())
                        kept.append(b" ".join(words).decode())
                    cols = [rows.column(f"c{i}").combine_chunks() for i in range(len(carry_type))]
                    yield pa.RecordBatch.from_arrays([*cols, pa.array(n_words[at : at + len(rows)], pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
                                                     [*[f"c{i}" for i in range(len(carry_type))], "n_words", "n_removed", "kept"])
    return run


def dedup(docs: DataFrame, order: str, text: str, carry: list[str], width: int = WINDOW, block_bytes: int = B.BLOCK_BYTES) -> DataFrame:
    """``carry`` columns of ``docs``, n_words, n_removed and the text that is kept (words joined by one blank)."""
    table = B.blocks(docs, order, text, carry, block_bytes)
    bits = B.bucket_bits(table.count())
    sent = table.select("block", "payload").mapInArrow(_send(width, bits), _SENT)
    answers = sent.groupBy("bucket").applyInArrow(_answer, "block long, bucket int, bits binary")
    by_block = answers.groupBy("block").agg(F.collect_list(F.struct("bucket", "bits")).alias("answers"))
    both = table.select("block", "payload").join(by_block, "block", "left").select("payload", "answers")
    types = [docs.schema[c].dataType.simpleString() for c in carry]
    fields = ", ".join([*[f"c{i} {t}" for i, t in enumerate(types)], "n_words long", "n_removed long", "kept string"])
    out = both.mapInArrow(_kept(width, bits, types), fields)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)], "n_words", "n_removed", "kept")


def op8_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256."""
    out = dedup(documents(spark, sf_dir), "doc_id", "text", ["doc_id"])
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
