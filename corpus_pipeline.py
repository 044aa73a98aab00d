"""From raw documents to training shards, in five stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowharbor.llm import decontaminate, langid, mixing, sharding, simhash
from rowharbor.llm.common import materialise

SHINGLE, RADIUS, SHARDS = 3, 2, 16


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (no text, or no letter in it) go."""
    return langid.keep_identified(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the least id stays."""
    return simhash.keep_one_per_group(docs, SHINGLE, RADIUS)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item go."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them; repeats are rows of their own."""
    return mixing.mixed_documents(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its shard and its place in it."""
    return sharding.shard_documents(docs, SHARDS, keep=docs.columns)


STAGES = [
    ("language", language),
    ("near_copies", near_copies),
    ("benchmark_leaks", benchmark_leaks),
    ("mixture", mixture),
    ("shards", shards),
]

ORACLE_SQL = None  # SQL has no kernel regression, SimHash or alignment


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each reads what the one before has written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
