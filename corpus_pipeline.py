"""A corpus from raw documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the one before it kept; all but the
last return the columns of ``documents``. :func:`run` writes each stage's rows to a scratch table
below ``spark.checkpoint.dir`` and reads them again as the next one's input, so a lost executor
costs no more than one stage's tasks. Texts go to Python workers in small batches, so
workers that serve one stage after the other stay small beside the executor's heap.
"""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sluice.llm import line_dedup, minhash, packing, pii, quality
from sluice.llm.frames import small_batches, store

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go."""
    return quality.keep_good(docs)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds go; ``n_chars`` follows the text."""
    small_batches(spark)
    return line_dedup.drop_repeated_lines(docs)


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the least ``doc_id`` stays."""
    small_batches(spark)
    return minhash.drop_near_duplicates(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets are replaced by their kind in brackets."""
    small_batches(spark)
    return pii.redact_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents become token pieces with a place in a training sequence."""
    small_batches(spark)
    return packing.pack_documents(docs, TOKENIZER)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_deduplication),
    ("MinHash near-dedup", near_deduplication),
    ("PII", personal_data),
    ("best-fit packing", best_fit_packing),
]

# tokenising and packing can't be said in SQL; tests hold run() against a brute-force pipeline
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; one row per packed piece."""
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = store(docs, f"stage{number}")
    return docs
