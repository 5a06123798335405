"""A training corpus from the documents table, stage by stage.

Each stage reads what the stage before it wrote and returns documents with
their own columns; the last adds shard and slot. Stages are written as Parquet
in the shared folder, so a lost executor repeats tasks of one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from basketlens.llm import decontaminate, hilbert_shards, jaccard_groups, language_id, source_mix
from basketlens.llm.common import small_batches
from basketlens.sources.staging import Workspace


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier accepts."""
    small_batches(spark)
    return language_id.accepted_rows(docs)


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each similarity component."""
    small_batches(spark)
    return jaccard_groups.one_per_component(docs)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage of weight."""
    small_batches(spark)
    return decontaminate.clean_rows(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    small_batches(spark)
    return source_mix.mix_rows(docs)


def cut_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and slot along the Hilbert curve."""
    return hilbert_shards.sharded_rows(docs)


STAGES = [
    ("language", keep_known_languages),
    ("similar", keep_one_of_similar),
    ("benchmark", keep_uncontaminated),
    ("mix", mix_sources),
    ("shards", cut_shards),
]

# Training, random draws and hashes have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    space = Workspace(spark, "corpus")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = space.save(stage(spark, docs, sf_dir), name)
    return docs
