"""The corpus pipeline: five stages over the documents, each a function of the rows that the stage before it kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidelake.llm import bpe, exact_dedup, minhash_join, mixing, quality_rules
from tidelake.llm.common import table
from tidelake.session import scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Words per shingle of the near-duplicate stage.
SHINGLE = 5


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the list learned from the labelled ones among them."""
    rules = quality_rules.fit(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    return quality_rules.keep_good(docs, rules)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each distinct text."""
    return exact_dedup.deduplicate(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return minhash_join.deduplicate(docs, shingle=SHINGLE)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids (little-endian 32-bit integers), their number, and digests of ids and decoded text, in place
    of columns that have these names already."""
    return bpe.with_tokens(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("exact_dedup", exact),
    ("minhash_join", near),
    ("mixing", mixture),
    ("bpe", tokens),
]

# Learned rules, random hashes and byte-pair merges are beyond SQL; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; between stages the rows are written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
