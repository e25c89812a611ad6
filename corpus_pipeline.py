"""Corpus pipeline: documents in, token ids out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame.  ``run`` writes
every result as Parquet under the session's shared checkpoint folder and hands
the reread table to the next stage, so a lost executor costs one stage at most.
All stages but the last return the columns of ``documents``.  A stage's scratch
tables are deleted when the next one begins, so its result must have been written
by then, as the tables here are.

Defined results: a document without text, or with none of a language, goes in the
first stage; of equal ids one row stays; rows without an id are grouped by their
texts; extra columns of any name are kept; an empty table gives no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventrollup.llm import op3_neardup, op4_bpe, op5_langid, op6_decontaminate, op10_pii
from eventrollup.llm.common import read_input, recorded, release, store

# Near-duplicates of the pipeline: five words, similarity 0.8 or more.
SHINGLE = 5
PERCENT = 80

# The method of the stages is not expressible in SQL; tests hold them against
# brute-force versions.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model knows; it learns from the labelled ones."""
    return op5_langid.keep_identified(docs, op5_langid.train(docs.select("doc_id", "text", "lang")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near-duplicates."""
    return op3_neardup.keep_first(docs, SHINGLE, PERCENT)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    items = read_input(spark, sf_dir, "benchmark", "item_id", "text")
    return op6_decontaminate.drop_contaminated(docs, items)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data and the terms that disclose it replaced."""
    return op10_pii.sanitise(docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digests of ids and decoded text."""
    coded = op4_bpe.encode_decode(docs, op4_bpe.tokenizer_path())
    return coded.select(
        "doc_id", "ids", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _freeing(stage: Stage) -> Stage:
    """``stage``, which first deletes the scratch tables of the stage before it: that
    one's result has been written when its reader is handed on as ``docs``."""
    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(spark)
        return recorded(stage, spark, docs, sf_dir)
    return run


STAGES: list[tuple[str, Stage]] = [(f.__name__, _freeing(f)) for f in (language_id, near_dedup, decontaminate, pii, bpe)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over the whole documents table."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
