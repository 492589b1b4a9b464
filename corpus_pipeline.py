"""The corpus pipeline: quality, line deduplication, near-duplicate removal, decontamination, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
``documents``. Stages work on all rows they are given: empty and null texts, repeated rows and further
columns pass through unless a stage's own rule removes them.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from corpusmill.llm import bpe, decontam, linedup, neardup, quality
from corpusmill.llm.shared import discard, staged
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Similarity, in percent, from which on documents are near duplicates.
NEAR_PERCENT = 80


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier keeps. Without labels of both kinds all stay.

    Null texts are judged as empty ones; every row of a repeated doc_id is judged by its own text.
    """
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines stay in the first document that has them; documents left with no line of their own go.

    Null and empty texts have no lines and stay; rows of one doc_id are cleaned each by its own text.
    """
    return linedup.dedup_stage(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group of near duplicates; one row of equal ids and texts.

    Rows with a null doc_id and documents without words stay. Rows that share a doc_id but not the text are
    judged apart, each by its own text.
    """
    found = staged(neardup.judged_rows(docs, NEAR_PERCENT), "pipeline-near")
    gone = found.filter("not kept").select(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key")).distinct()
    left = docs.join(gone, (docs["doc_id"] == gone["gone_id"]) & (neardup.text_key(docs) == gone["gone_key"]), "left_anti")
    repeated = found.filter("kept and doc_id is not null").groupBy("doc_id", "text_key").count().filter("count > 1")
    if repeated.isEmpty():
        return left
    return left.filter("doc_id is null").unionByName(left.filter("doc_id is not null").dropDuplicates(["doc_id", "text"]))


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut; documents that are mostly benchmark text go. Null and empty texts stay as they are."""
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, n_bytes of each document that is left; null and empty texts have no ids."""
    return bpe.encode_digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("lines", line_stage),
    ("near_duplicates", near_stage),
    ("decontamination", benchmark_stage),
    ("encoding", encode_stage),
]

#: The classifier, the similarity join and the tokenizer are beyond SQL; tests hold ``run`` against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written as Parquet and read again for the next, after which its own input goes."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        done = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
        discard(docs)  # a table that the stage before wrote; others are left alone
        docs = done
    return STAGES[-1][1](spark, docs, sf_dir)
