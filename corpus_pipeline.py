"""The corpus pipeline: documents to tokens, in five stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, written as
Parquet and read again as the next one's docs. All but the last return the
columns of documents. Side tables (labels, benchmark) come from sf_dir.
The quality stage judges each row, with or without an id, by its own text. The
next two decide by doc_id: rows of one doc_id stand or fall together there, and
rows without one stay. The secret scan changes each row by its own text. Null,
empty and repeated texts go through every stage (the quality stage rejects null
and empty ones); an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quorate.llm import bpe, decontam, ngram_join, quality_rules, secret_scan
from quorate.llm.common import delete, ready, release


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _afresh(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage, after the driver's garbage of the stages before it is collected: the heap that it held goes back to the system."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(spark)
        return stage(spark, docs, sf_dir)

    return run


@_afresh
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality rules keep; a row is known by its id and a hash of what is judged."""
    row = F.xxhash64("doc_id", "text", "lang")
    verdicts = quality_rules.apply_quality_rules(docs.withColumn("_row", row), _table(spark, sf_dir, "labels"), keep=("_row",))
    gone = verdicts.where(~F.col("kept")).select(F.col("doc_id").alias("_id"), "_row").distinct()
    return docs.join(gone, F.col("doc_id").eqNullSafe(F.col("_id")) & (row == F.col("_row")), "left_anti").select(*docs.columns)


@_afresh
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least doc_id of each group of near copies."""
    groups = ngram_join.similar_components(docs)
    return docs.join(groups.where("component_id < doc_id").select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


@_afresh
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    leaks = decontam.find_leaks(docs, _table(spark, sf_dir, "benchmark"))
    return docs.join(leaks.select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


@_afresh
def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with its secrets replaced; n_chars follows the new text."""
    return secret_scan.redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


@_afresh
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the bytes they decode to."""
    import public_tokenizers

    return bpe.round_trip_digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontaminate),
    ("secret_scans", secrets),
    ("byte_level_bpe", tokens),
]

#: The SVD of the third stage and the tokenizer cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents; each result is a Parquet table in the shared checkpoint folder.

    A stage's table is deleted once the next one is written; the last stage reads the one that stays.
    """
    ready(spark)
    base = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/pipeline-{uuid.uuid4().hex}"
    docs = _table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
        if before:
            delete(spark, before)
        before = f"{base}/{name}"
    return STAGES[-1][1](spark, docs, sf_dir)
