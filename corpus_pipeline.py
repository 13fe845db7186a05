"""From documents to shards of a training mix: language, near-duplicates, benchmarks, mixing, sharding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bulletin.llm import decontaminate, language_id, mixing, near_dedup, sharding
from bulletin.llm.common import settle


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that none of the languages explains; all labelled documents teach, none is held out."""
    model = language_id.train(docs)
    return language_id.identify(docs, model).filter("not rejected").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each class of near copies (five words, 0.8) the document with the smallest id; rows without a text are one class."""
    return near_dedup.drop_near_duplicates(docs)


def drop_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item; items without words match nothing."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice."""
    return mixing.apply_mix(docs)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds `shard, shard_bytes, shard_docs`, which replace columns of these names."""
    return sharding.shard(docs)


STAGES = [
    ("language identification", identify_language),
    ("near-duplicates", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmarks),
    ("mixing", mix_sources),
    ("sharding", assign_shards),
]

#: Language models and lots have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
