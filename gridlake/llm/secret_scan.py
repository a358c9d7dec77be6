"""Secret scan: fixed patterns, and character Markov models of random strings against ordinary identifiers.

The base kinds are patterns (``assign``, ``access``, ``hex``). The method adds ``markov`` spans: each run of 20 or
more characters of the model's alphabet is scored by the logarithm of the ratio of two first-order character models,
one of random strings and one of ordinary identifiers, and is a secret if its mean per step is above a threshold.
Both models are trained here, from labelled samples: random strings are spelt from digests (hexadecimal, upper-case
base 36, base 64); ordinary identifiers are the words of documents, alone and joined as in code. The corpus sample
is bounded: the ``SAMPLE_DOCS`` texts with the least hashes, each word once. The models are tables of
``len(ALPHABET) ** 2`` numbers, so that they fit in a literal.

Only built-in functions are used. Positions come from splitting a text at the matches and adding lengths. A
document's matches stay in its row; nothing but the bounded training sample is shuffled.

Defined results: a null text is empty and has no spans; repeated rows are judged each; an empty table trains models
from random strings and from nothing (all steps equally likely) and gives an empty result; spans count code points,
end exclusive; other columns are left out of the query and don't clash with it.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.llm._session import free_name

#: Base patterns by kind, in the order in which ties are listed (fixed values); ``hex`` and ``access`` hold their
#: least length, because a maximal run that is too short can't hold a longer one.
BASE = {
    "assign": r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"[0-9a-f]{24,}",
}
KINDS = (*BASE, "markov")
LEAST_VALUE = 6
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
RUN = r"[A-Za-z0-9+/_=-]{20,}"
#: Training sample: documents, random strings of each spelling, and the threshold of the mean log-ratio per step.
SAMPLE_DOCS = 2000
RANDOM_STRINGS = 4000
THRESHOLD = 0.25


_SPANS = "array<struct<start:int,end:int,rank:int,kind:string>>"


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once: an expression that is named twice is computed twice."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _chunked(items: Column) -> Column:
    """An array as chunks of about as many items as there are chunks, so that a running sum costs little more than its items."""
    side = F.greatest(F.ceil(F.sqrt(F.size(items))), F.lit(1)).cast("int")
    return _let(side, lambda n: F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.size(items) / n).cast("int") - 1, F.lit(0))), lambda k: F.slice(items, k * n + 1, n)))


def _running(chunks: Column, first: Column, fold, start) -> Column:
    """The value that each chunk begins with: ``fold`` is a chunk's own value, ``start`` joins it to the one before."""
    begin = F.aggregate(F.transform(chunks, fold), F.array(first), lambda acc, x: F.concat(acc, F.array(start(F.element_at(acc, -1), x))))
    return F.slice(begin, F.lit(1), F.size(chunks))


def _along(items: Column, first: Column, fold, start, inside) -> Column:
    """``inside(chunk, value that it begins with)``, an array, for all chunks of ``items``, one after another."""
    whole = lambda chunks: F.flatten(F.zip_with(chunks, _running(chunks, first, fold, start), inside))
    return _let(items, lambda all_items: _let(_chunked(all_items), whole))


def _spans(text: Column, pattern: str, kind: str, keep=None) -> Column:
    """Array of (start, end, rank, kind) of the matches of ``pattern``; ``keep`` tests a match. A match starts after all
    pieces and matches before it: their lengths are summed chunk by chunk, then within each chunk."""
    pieces = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    kept = keep if keep is not None else lambda m: F.lit(True)
    one = lambda p, m: F.struct(F.length(p).alias("gap"), F.length(m).alias("size"), kept(m).alias("kept"))
    both = _let(matches, lambda found: F.zip_with(F.slice(pieces, F.lit(1), F.size(found)), found, one))

    def step(acc, x):
        return _let(acc["at"] + x["gap"], lambda start: _let(start + x["size"], lambda end: F.struct(end.alias("at"), F.when(x["kept"], F.concat(acc["spans"], F.array(
            F.struct(start.alias("start"), end.alias("end"), F.lit(KINDS.index(kind)).alias("rank"), F.lit(kind).alias("kind"))))).otherwise(acc["spans"]).alias("spans"))))

    inside = lambda c, at: F.aggregate(c, F.struct(at.alias("at"), F.array().cast(_SPANS).alias("spans")), step, lambda acc: acc["spans"])
    found = _along(both, F.lit(0), lambda c: F.aggregate(c, F.lit(0), lambda acc, x: acc + x["gap"] + x["size"]), lambda before, own: before + own, inside)
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(_SPANS))


def _value_is_long(match: Column) -> Column:
    return F.length(F.regexp_extract(match, BASE["assign"], 2)) >= LEAST_VALUE


def _steps(words: DataFrame, label: str) -> DataFrame:
    """Counts of neighbouring characters of the alphabet in the column ``w``."""
    at = F.explode(F.sequence(F.lit(1), F.length("w") - 1)).alias("k")
    pairs = words.filter(F.length("w") > 1).select("w", at).select(F.substring("w", F.col("k"), 1).alias("a"),
                                                                  F.substring("w", F.col("k") + 1, 1).alias("b"))
    index = (F.instr(F.lit(ALPHABET), F.col("a")) - 1) * len(ALPHABET) + F.instr(F.lit(ALPHABET), F.col("b")) - 1
    both = F.lit(ALPHABET).contains(F.col("a")) & F.lit(ALPHABET).contains(F.col("b"))
    return pairs.filter(both).groupBy(index.alias("step")).agg(F.count(F.lit(1)).alias(label))


def labelled_strings(docs: DataFrame, text: str, sample_docs: int = SAMPLE_DOCS, strings: int = RANDOM_STRINGS) -> tuple[DataFrame, DataFrame]:
    """The labelled samples, as frames with the column ``w``: random strings, ordinary identifiers."""
    ids = docs.sparkSession.range(strings).select(F.col("id").cast("string").alias("id"))
    digest = F.sha2(F.col("id"), 256)
    base36 = F.concat(*[F.conv(F.substring(digest, 1 + 12 * k, 12), 16, 36) for k in range(4)])
    random = ids.select(F.explode(F.array(digest, base36, F.base64(F.unhex(digest)))).alias("w"))
    # the texts of the least hashes, each once: hashes alone are sorted, and texts stay where they are read
    texts = docs.select(F.col(f"`{text}`").cast("string").alias("t")).filter("t is not null")
    last = texts.select(F.xxhash64("t").alias("h")).distinct().orderBy("h").limit(sample_docs).agg(F.max("h")).first()[0]
    sample = texts.filter(F.xxhash64("t") <= (last if last is not None else 0))
    words = sample.select(F.explode(F.split("t", r"[^A-Za-z]+")).alias("x")).filter(F.length("x") >= 2).groupBy("x").agg(F.min("x").alias("w")).select("w")
    marked = words.select(F.explode(F.array(F.col("w"), F.concat(F.initcap("w"), F.initcap("w")), F.concat(F.lower("w"), F.lit("_"), F.lower("w")),
                                            F.concat(F.lower("w"), F.lit("-"), F.lower("w")), F.concat(F.lower("w"), F.lit("/"), F.lower("w")))).alias("w"))
    return random, marked


def train(docs: DataFrame, text: str, sample_docs: int = SAMPLE_DOCS) -> list[float]:
    """Log-ratios by step (first character * size + second): a table of fixed size, gathered to the driver."""
    random, ordinary = labelled_strings(docs, text, sample_docs)
    n = len(ALPHABET)
    counts = _steps(random, "r").join(_steps(ordinary, "o"), "step", "full").fillna(0)
    r, o = [1.0] * (n * n), [1.0] * (n * n)  # each step counts once more than seen
    for step, in_random, in_ordinary in counts.select("step", "r", "o").collect():
        r[step] += in_random
        o[step] += in_ordinary
    import math

    out = []
    for a in range(n):
        rows = slice(a * n, (a + 1) * n)
        sum_r, sum_o = sum(r[rows]), sum(o[rows])
        out += [round(math.log(x / sum_r) - math.log(y / sum_o), 6) for x, y in zip(r[rows], o[rows], strict=True)]
    return out


def mean_ratio(run: Column, table: list[float]) -> Column:
    """Mean log-ratio per step of a run of the alphabet; its characters are looked up once each."""
    n = len(ALPHABET)
    # one string literal, which the optimizer turns into one array: a plan with thousands of literals is slow to analyse
    values = F.split(F.lit(",".join(map(str, table))), ",").cast("array<double>")
    places = F.transform(F.slice(F.split(run, ""), F.lit(1), F.length(run)), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    steps = lambda at: F.zip_with(F.slice(at, F.lit(1), F.size(at) - 1), F.slice(at, F.lit(2), F.size(at) - 1), lambda a, b: F.element_at(values, a * n + b + 1))
    return F.aggregate(_let(places, steps), F.lit(0.0), lambda acc, x: acc + x) / (F.length(run) - 1)


def _mixed(run: Column) -> Column:
    """Random strings of 20 characters hold a digit and a letter; runs of one class are words, rules or numbers."""
    return run.rlike("[0-9]") & run.rlike("[A-Za-z]")


def spans(text: Column, table: list[float], threshold: float = THRESHOLD) -> tuple[Column, Column]:
    """Base spans and all spans of a text: arrays of (start, rank, end, kind) by start, then kind as listed."""
    t = F.coalesce(text, F.lit(""))
    base = F.concat(_spans(t, BASE["assign"], "assign", _value_is_long), _spans(t, BASE["access"], "access"), _spans(t, BASE["hex"], "hex"))
    extra = _spans(t, RUN, "markov", lambda m: _mixed(m) & (mean_ratio(m, table) >= threshold))

    def ordered(found: Column) -> Column:
        return F.array_sort(F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))))

    return ordered(base), ordered(F.concat(base, extra))


def scan(df: DataFrame, text: str, table: list[float], threshold: float = THRESHOLD) -> DataFrame:
    """``df`` with ``base_spans`` and ``all_spans``."""
    base, every = spans(F.col(f"`{text}`"), table, threshold)
    return df.withColumn("base_spans", base).withColumn("all_spans", every)


def spelt(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(df: DataFrame, text: str, table: list[float], n_chars: str) -> DataFrame:
    """``df`` with each span (joined where they overlap) of ``text`` replaced by ``<secret>``; ``n_chars`` is the length
    of a text that is changed. Other rows and all other columns stay as they are."""
    found = free_name(df, "spans")
    t = F.col(f"`{text}`")
    held = df.withColumn(found, spans(t, table)[1])
    ends = lambda c: F.array_max(F.transform(c, lambda s: s["end"]))

    def marked(chunk, at):
        """The text from ``at`` to the last end of the chunk with marks; each span is cut out of that part, not of the whole."""
        def step(part):
            def run(acc, s):
                ahead = s["end"] > acc["at"]
                apart = (s["start"] > acc["at"]) | (acc["at"] == 0)
                lead = F.when(s["start"] > acc["at"], F.substring(part, acc["at"] - at + 1, s["start"] - acc["at"])).otherwise("")
                piece = F.when(ahead, F.concat(lead, F.when(apart, F.lit("<secret>")).otherwise(""))).otherwise("")
                return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], F.array(piece)).alias("out"))
            return run

        start = F.struct(at.alias("at"), F.array().cast("array<string>").alias("out"))
        return _let(F.substring(t, at + 1, F.greatest(ends(chunk) - at, F.lit(0))), lambda part: F.aggregate(chunk, start, step(part), lambda acc: acc["out"]))

    pieces = _along(F.col(found), F.lit(0), ends, lambda before, own: F.greatest(before, own), marked)
    rest = _let(ends(F.col(found)), lambda end: F.substring(t, end + 1, F.greatest(F.length(t) - end, F.lit(0))))
    cleaned = F.concat(F.array_join(pieces, ""), rest)
    held = held.withColumn(text, F.when(F.size(found) > 0, cleaned).otherwise(t))
    kind = df.schema[n_chars].dataType
    return held.withColumn(n_chars, F.when(F.size(found) > 0, F.length(t)).otherwise(F.col(f"`{n_chars}`")).cast(kind)).drop(found)


def op6_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_markov."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = scan(docs, "text", train(docs, "text"))
    count = lambda kind: F.size(F.filter("all_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in BASE], F.sha2(spelt(F.col("base_spans")), 256).alias("base_sha256"), spelt(F.col("all_spans")).alias("spans"), count("markov"))
