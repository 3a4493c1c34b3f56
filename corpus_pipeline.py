"""Corpus pipeline: language ID, near-dedup, decontamination, mixing, sharding.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read back as the next stage's ``docs``.  All stages but
the last return the columns of ``documents``; sharding adds shard and slot.

The result holds for nulls in any column, empty and very long texts, repeated
rows, an empty table and extra columns: each stage names in its operator's
module what becomes of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporium.llm import decontamination, language_id, mixing, sharding, simhash_dedup
from emporium.session import apply_conf, materialise


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without an identified language go."""
    sample = language_id.training_sample(docs.where(~language_id.held_out()))
    return language_id.keep_identified(docs, language_id.train(sample))


def near_deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: one document of each group stays."""
    return simhash_dedup.keep_one_per_group(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that hold a benchmark item go."""
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontamination.keep_clean(docs, items)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: documents repeat or drop out to meet their source's target."""
    return mixing.mix(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sharding: every document gets a shard and a slot in it."""
    return sharding.shard(docs)


STAGES = [
    ("language_id", identified),
    ("simhash_dedup", near_deduplicated),
    ("decontamination", decontaminated),
    ("mixing", mixed),
    ("sharding", sharded),
]

#: SQL can express neither the trained classifier nor SimHash: the stages are
#: tested against brute force instead (tests/llm).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    apply_conf(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
