"""A training corpus from ``documents``: quality, near duplicates,
benchmark leaks, token ids.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps
with the columns of ``documents``; the last returns token ids. Between
stages the documents are written as Parquet and read again.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import byte_bpe, decontamination, ngram_join, quality
from tallyhouse.llm.common import bound_batches, crc32_of, read_table, saved

KEPT_SCORE = 0.7

#: A learnt classifier decides the first stage, which SQL cannot express;
#: tests hold the pipeline against brute force.
ORACLE_SQL = None


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the quality classifier rejects; it learns from labels of
    three quarters of the ids."""
    taught = crc32_of("doc_id") % 4 != 2
    forest = quality.fit(docs.where(taught), read_table(spark, sf_dir, "labels").where(taught))
    scored = quality.score(docs, forest, output="__score")
    return scored.where(F.col("__score") >= KEPT_SCORE).drop("__score")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of five-word shingle sets that link
    at a Jaccard similarity of four fifths or more."""
    bound_batches(spark)
    return ngram_join.keep_one(docs, 4, 5, width=5)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that overlap with a benchmark item."""
    return decontamination.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every whole text, and whether they decode to it."""
    bound_batches(spark)
    vocabulary, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    coded = byte_bpe.encode(docs.select("doc_id", "text"), vocabulary, pattern)
    return coded.select("doc_id", "encoded.n_tokens", "encoded.ids", "encoded.decodes")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_filter", quality_filter),
    ("near_duplicates", near_duplicates),
    ("benchmark_leaks", benchmark_leaks),
    ("token_ids", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
