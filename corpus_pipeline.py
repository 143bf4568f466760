"""The training-data pipeline over `documents`: stages that are each written as
Parquet and read again. Every stage decides by row, never by id: rows that share an
id, or have none, are judged each by its own text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, decontaminate, jaccard, quality
from tidemark.llm.common import persist, shipped, table
from tidemark.llm.queries import tokenizer


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.kept(spark, docs, table(spark, sf_dir, "labels"))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates the row of the smallest id stays, the
    first of equal ones. Documents without words are no duplicates and stay."""
    return jaccard.one_of_each(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of what is left, without the texts."""
    path, pattern = tokenizer()
    encoded = bpe.encode(docs.select("doc_id", "text", "lang", "source"), "text", path, pattern)
    return encoded.selectExpr("doc_id", "lang", "source", "size(token_ids) AS n_tokens",
                              "token_ids")


STAGES = [("quality_classifier", shipped(keep_quality)),
          ("ngram_jaccard_join", shipped(keep_one_of_near_copies)),
          ("benchmark_decontamination", shipped(drop_benchmark_leaks)),
          ("bpe_encoding", shipped(encode_tokens))]

# SQL has neither the language model, nor aligned edits, nor byte pair merges:
# tests/llm holds run() against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage on all that the one before kept."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = persist(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
