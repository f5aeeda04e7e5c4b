"""Corpus pipeline: quality rules, near duplicates, repeated passages, benchmark items, token ids.

Every stage takes (spark, docs, sf_dir) and all documents the one before kept. Stages but the last return documents' columns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.llm import op2_bpe, op4_decontaminate, op5_quality, op8_jaccard, op10_substring
from tillstream.llm.queries import RANKS, table
from tillstream.llm.scratch import ship, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the rules reject."""
    ship(spark)
    return op5_quality.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of each group linked by a Jaccard similarity of 0.8 or more on five words."""
    ship(spark)
    return op8_jaccard.one_each(docs, size=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts out words that repeat an earlier window; ``n_chars`` follows the text."""
    ship(spark)
    cut = op10_substring.deduplicated(docs)
    return cut.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else cut


def benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain a benchmark item."""
    return op4_decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes every text and decodes it again: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    ship(spark)
    of = op2_bpe.digests(spark, F.col("text"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return docs.select("doc_id", of.alias("d")).select("doc_id", "d.*")


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages),
          ("benchmark_items", benchmark_items), ("token_ids", token_ids)]
ORACLE_SQL = None  # SQL cannot express the encoding; tests hold the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
