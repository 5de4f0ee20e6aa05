"""A pipeline from raw documents to packed batches, in five stages.

Each stage takes what its predecessor kept, written as Parquet and reread, and all but the last
return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, ngram_join, packing, quality, secret_ledger, shared

#: The classifier is learned, so SQL cannot express the rows of run().
ORACLE_SQL: str | None = None


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that score at least the threshold; the model never sees held-out labels.

    Null and empty texts are scored too; columns of docs, whatever their names, stay as they are.
    """
    learn = shared.bucket_of_id(F.col("doc_id")) != 2
    model = quality.fit(docs.where(learn), shared.table(spark, sf_dir, "labels").where(learn))
    return quality.score(docs, model, into="__quality").where(F.col("__quality") >= quality.THRESHOLD).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, that with the smallest doc_id, of each group of near duplicates."""
    return ngram_join.keep_one(docs).select(*docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark item, also one with other parameters."""
    return decontaminate.remove(docs, shared.table(spark, sf_dir, "benchmark")).select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the text by a mark; n_chars follows. No document goes."""
    masked = secret_ledger.mask(docs)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))
    return masked.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all documents in token-budget batches of optimal length buckets."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", drop_low_quality),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("secret_scan", mask_secrets),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from the table documents."""
    docs = shared.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = shared.written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
