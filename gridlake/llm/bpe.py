"""Byte-level BPE: encoding and decoding by reduction over a tree.

Encoding is a monoid homomorphism once neighbours know how to join. A text is cut into halves down to leaves of
``LEAF_CHARS``; a leaf is cut into pieces by the tokenizer's pattern. Joining two parts cuts anew a window around their
border, which grows to the right until it meets a piece border of the right part: where a piece begins, what follows
depends on the rest of the text alone, so all later pieces stand. To the left, pieces before the last three stand,
because the pattern looks at most two characters beyond a piece that isn't last.

A piece is encoded alike: halves down to ``LEAF_BYTES`` by the merges themselves; two parts are joined by encoding
anew the tokens around the border. The window grows until each token outside agrees with its new neighbour: a
sequence of tokens is the encoding of its bytes if and only if each pair of neighbours is the encoding of the pair's
bytes, so then all tokens outside are proved to stand. Pieces repeat; a bounded memo in each task keeps their tokens.

Decoding maps ids to bytes in leaves of ``LEAF_IDS`` and concatenates up the tree.

No shuffle: every text is encoded where it is read. Ranks come from a vocabulary file read once by the driver and
broadcast (bounded by the vocabulary). A task holds an Arrow batch, and the tokens of one text.

Defined results: a null text is empty, an empty text has no tokens; repeated rows are encoded each; an empty table
gives an empty result; unpaired surrogates can't occur in Spark strings; columns named like an output column are
replaced, others stay.
"""
from __future__ import annotations

import base64
import hashlib
import heapq

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm._session import documents, prepare

VOCABULARY = "byte_bpe_50k.tiktoken"
LEAF_CHARS = 1 << 11
LEAF_BYTES = 8
#: Windows of more bytes are merged with a heap; pieces of more characters aren't kept in the memo.
WIDE = 128
LEAF_IDS = 1 << 14
MEMO_PIECES = 400_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a vocabulary file (base 64 and a number on each line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Codec:
    """Encoder and decoder for one vocabulary and one pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, pattern
        self._setup()

    def _setup(self) -> None:
        self.find = regex.compile(self.pattern)
        self.tokens: list[bytes] = [b""] * (max(self.ranks.values(), default=-1) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.names = [str(i) for i in range(len(self.tokens))]
        self.memo: dict[str, tuple[int, ...]] = {}
        self.pairs: dict[tuple[int, int], bool] = {}

    def __getstate__(self):
        return self.ranks, self.pattern

    def __setstate__(self, state):
        self.ranks, self.pattern = state
        self._setup()

    # --- pieces -> tokens

    def _merged(self, data: bytes) -> list[int]:
        """Merge the neighbours of the lowest rank, the first of equal ones, until none is left."""
        if len(data) > WIDE:
            return self._merged_long(data)
        ranks, parts = self.ranks, [data[i : i + 1] for i in range(len(data))]
        none = len(self.tokens)
        pairs = [ranks.get(data[i : i + 2], none) for i in range(len(data) - 1)]
        while pairs and (best := min(pairs)) < none:
            at = pairs.index(best)
            parts[at] += parts.pop(at + 1)
            del pairs[at]
            if at < len(pairs):
                pairs[at] = ranks.get(parts[at] + parts[at + 1], none)
            if at:
                pairs[at - 1] = ranks.get(parts[at - 1] + parts[at], none)
        return [ranks[p] for p in parts]

    def _merged_long(self, data: bytes) -> list[int]:
        """The same with a heap of pairs, for wide windows."""
        n, ranks = len(data), self.ranks
        end, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (rank := ranks.get(data[i : end[j]])) is not None:
                heapq.heappush(heap, (rank, i, end[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, to = heapq.heappop(heap)
            j = after[i] if end[i] else n
            if j >= n or end[j] != to:
                continue
            end[i], end[j] = to, 0
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        out, i = [], 0
        while i < n:
            out.append(ranks[data[i : end[i]]])
            i = after[i]
        return out

    def _stands(self, a: int, b: int) -> bool:
        """Whether two tokens are the encoding of their bytes."""
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= MEMO_PIECES:
                self.pairs.clear()
            known = self.pairs[a, b] = self._merged(self.tokens[a] + self.tokens[b]) == [a, b]
        return known

    def _join(self, left: list[int], right: list[int]) -> list[int]:
        if not left or not right or self._stands(left[-1], right[0]):
            return left + right
        i = j = 1
        while True:
            window = self._merged(b"".join(self.tokens[t] for t in left[len(left) - i :] + right[:j]))
            held = i == len(left) or self._stands(left[-i - 1], window[0])
            holds = j == len(right) or self._stands(window[-1], right[j])
            if held and holds:
                return left[: len(left) - i] + window + right[j:]
            i = i if held else min(2 * i, len(left))
            j = j if holds else min(2 * j, len(right))

    def _reduce(self, data: bytes) -> list[int]:
        if len(data) <= LEAF_BYTES:
            return self._merged(data)
        half = len(data) // 2
        return self._join(self._reduce(data[:half]), self._reduce(data[half:]))

    def piece(self, text: str) -> tuple[int, ...]:
        known = self.memo.get(text)
        if known is None:
            data = text.encode("utf-8", "replace")
            rank = self.ranks.get(data)
            known = (rank,) if rank is not None else tuple(self._reduce(data))
            if len(self.memo) >= MEMO_PIECES:
                self.memo.clear()
            if len(text) <= WIDE:
                self.memo[text] = known
        return known

    # --- text -> pieces

    def _cut(self, text: str, lo: int, hi: int) -> list[str]:
        """The pieces of ``text[lo:hi]``, taken alone."""
        if hi - lo <= LEAF_CHARS:
            return self.find.findall(text[lo:hi])
        mid = (lo + hi) // 2
        return self._join_cuts(text, self._cut(text, lo, mid), self._cut(text, mid, hi), mid, hi)

    def _join_cuts(self, text: str, left: list[str], right: list[str], mid: int, hi: int) -> list[str]:
        tail = left[-3:]
        start, reach = mid - sum(map(len, tail)), 64
        del left[len(left) - len(tail) :]
        while True:
            stop = min(hi, mid + reach)
            window = self.find.findall(text[start:stop])
            if stop == hi:
                return left + window
            # the last three pieces of the window may depend on what follows it
            at, other, nth = start, mid, 0
            for k in range(len(window) - 3):
                while other < at:
                    other += len(right[nth])
                    nth += 1
                if at == other:
                    left += window[:k]
                    left += right[nth:]
                    return left
                at += len(window[k])
            reach *= 4

    def pieces(self, text: str) -> list[str]:
        return self._cut(text, 0, len(text))

    # --- whole texts

    def encode(self, text: str | None) -> list[int]:
        memo, out = self.memo, []
        for p in self.pieces(text or ""):
            known = memo.get(p)
            out += known if known is not None else self.piece(p)
        return out

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= LEAF_IDS:
            return b"".join(map(self.tokens.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


def _mapped(df: DataFrame, column: str, kind: str, codec: Codec, out: dict[str, str], make) -> DataFrame:
    """``df`` with columns that ``make(codec, value)`` gives (a tuple) for each value of ``column``."""
    spark = prepare(df.sparkSession)
    shared = spark.sparkContext.broadcast(codec)
    kept = [c for c in df.columns if c not in out]
    packed = df.select(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)]).alias("row") if kept else F.struct(F.lit(0).alias("none")).alias("row"),
                       F.col(f"`{column}`").cast(kind).alias("value"))
    schema = f"row {packed.schema['row'].dataType.simpleString()}, " + ", ".join(f"o{i} {t}" for i, t in enumerate(out.values()))
    types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32())}

    def run(batches):
        for batch in batches:
            # a slice at a time, so that the tokens of a whole batch are never held
            for at in range(0, len(batch), 64):
                rows = batch.slice(at, 64)
                made = [make(shared.value, v) for v in rows.column("value").to_pylist()]
                cols = [pa.array(c, types[t]) for c, t in zip(zip(*made), out.values())]
                yield pa.RecordBatch.from_arrays([rows.column("row"), *cols], ["row", *[f"o{i}" for i in range(len(out))]])

    mapped = packed.mapInArrow(run, schema)
    return mapped.select(*[F.col("row")[f"c{i}"].alias(c) for i, c in enumerate(kept)], *[F.col(f"o{i}").alias(c) for i, c in enumerate(out)])


def encode(df: DataFrame, text: str, codec: Codec) -> DataFrame:
    """``df`` with ``ids`` (array<int>) and ``n_tokens`` of each whole text."""
    def make(own: Codec, value):
        ids = own.encode(value)
        return ids, len(ids)
    return _mapped(df, text, "string", codec, {"ids": "array<int>", "n_tokens": "long"}, make)


def decode(df: DataFrame, ids: str, codec: Codec) -> DataFrame:
    """``df`` with ``decoded`` (binary), the bytes of an array of ids; null ids have none."""
    return _mapped(df, ids, "array<int>", codec, {"decoded": "binary"}, lambda own, value: (own.decode(value or []),))


def round_trip(df: DataFrame, text: str, codec: Codec) -> DataFrame:
    """``df`` with n_tokens and digests of the ids and of the bytes they decode to; the ids stay in the task."""
    def make(own: Codec, value):
        ids = own.encode(value)
        spelt = " ".join(map(own.names.__getitem__, ids))
        return len(ids), hashlib.sha256(spelt.encode()).hexdigest(), hashlib.sha256(own.decode(ids)).hexdigest()
    return _mapped(df, text, "string", codec, {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}, make)


def default_codec(path: str | None = None) -> Codec:
    import public_tokenizers

    return Codec(read_ranks(path or public_tokenizers.path(VOCABULARY)), public_tokenizers.PATTERN)


def op3_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return round_trip(docs, "text", default_codec()).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
