"""Queries of the training-data operators: name → (spark, sf_dir) → DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporium.llm import (
    chat_trees, decontamination, language_id, license_scan, line_dedup, merkle, mixing,
    personal_data, repetition, sharding, simhash_dedup, spelling, token_files,
)
from emporium.session import apply_conf

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    apply_conf(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet").select(*columns)


def op1_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.quality(_documents(spark, sf_dir, "doc_id", "text"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digest(_documents(spark, sf_dir, "doc_id", "text"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(_documents(spark, sf_dir, "doc_id", "text"))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.summary(_documents(spark, sf_dir, "doc_id", "text"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontamination.matches(_documents(spark, sf_dir, "doc_id", "text"), items)


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicate_groups(_documents(spark, sf_dir, "doc_id", "text"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.digest(_documents(spark, sf_dir, "doc_id", "text"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(_documents(spark, sf_dir, "doc_id", "text", "lang"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(_documents(spark, sf_dir, "doc_id", "text"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(_documents(spark, sf_dir, "doc_id", "text", "source"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.digest(_documents(spark, sf_dir, "doc_id", "text"))


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_conf(spark)
    return chat_trees.digest(spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.digest(_documents(spark, sf_dir, "doc_id", "text", "lang", "source", "n_chars"))


def queries() -> dict[str, Query]:
    import corpus_pipeline

    ops = (op1_repetition, op2_sharding, op3_license_scan, op4_personal_data,
           op5_benchmark_decontamination, op6_simhash_dedup, op7_token_files, op8_language_id,
           op9_line_dedup, op10_mixing, op11_spelling_variants, op12_chat_format,
           op13_merkle_manifest)
    return {f.__name__: f for f in ops} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {"op10_mixing": mixing.ORACLE, "op11_spelling_variants": spelling.ORACLE,
            "op12_chat_format": chat_trees.ORACLE,
            "op13_merkle_manifest": merkle.ORACLE}
