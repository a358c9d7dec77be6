"""Corpus pipeline: toxicity, near duplicates, benchmark contamination, secrets, tokens.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir), where docs are the rows that its
predecessor kept, and returns a DataFrame. ``run`` writes each stage's rows as Parquet to the shared folder and reads
them again as the next one's docs, so that a lost executor costs a stage at most. All stages but the last return the
columns of docs; rows that a stage doesn't object to pass unchanged.

Nulls: a null or empty text passes toxicity (unless the score of no features is high), near deduplication keeps one
row of equal texts without words, nothing in it is contaminated or secret, and it has no tokens. Extra columns of docs
pass through. An empty table stays empty.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.llm import bpe, decontaminate, near_dedup, secret_scan, toxicity
from gridlake.llm._session import drop_tables, free_name, keep_tables, prepare, scope, written

#: SQL can't express sketches, a trained classifier and BPE; tests compare with brute force instead.
ORACLE_SQL = None


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the classifier, trained on labelled rows of its input, predicts to be toxic."""
    prepare(spark)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    name = free_name(docs, "score")
    scored = toxicity.score(docs, model, docs.columns, name)
    return scored.filter(F.col(name) < toxicity.THRESHOLD).select(*docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the least doc_id of each group of near copies."""
    return near_dedup.dedup(docs, "doc_id", "text")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that items of the benchmark contaminate."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.clean(docs, "text", items, "item_id", "text")


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces each secret by a mark; ``n_chars`` follows the text. All documents stay."""
    return secret_scan.redact(docs, "text", secret_scan.train(docs, "text"), "n_chars").select(*docs.columns)


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text: doc_id, lang, source, ids, n_tokens."""
    return bpe.encode(docs.select("doc_id", "lang", "source", "text"), "text", bpe.default_codec()).select("doc_id", "lang", "source", "ids", "n_tokens")


def _stage(function):
    """The tables that a stage has written on its way are dropped when the next stage begins: its rows are written by then."""
    def staged(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_tables(spark, _SCOPE)
        with scope(_SCOPE):
            return function(spark, docs, sf_dir)
    return staged


_SCOPE = "pipeline"

STAGES = [
    ("toxicity", _stage(toxicity_stage)),
    ("minhash near-dedup", _stage(near_dedup_stage)),
    ("benchmark decontamination", _stage(decontamination_stage)),
    ("secret scan", _stage(secrets_stage)),
    ("byte-level bpe", _stage(tokens_stage)),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), ""
    for name, stage in STAGES:
        made, own = stage(spark, docs, sf_dir), f"{_SCOPE}: {name}"
        with scope(own):
            docs = written(made, name.replace(" ", "-"))
        drop_tables(spark, before)
        before = own
    drop_tables(spark, _SCOPE)
    keep_tables(before)
    return docs
