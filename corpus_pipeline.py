"""The corpus pipeline: documents in, a deduplicated, decontaminated, redacted and mixed corpus out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from larkspur.llm import decontaminate, mixing, quality_rules, secret_scan, simhash
from larkspur.session import work_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: shingles of three words, at most three bits apart."""
    return simhash.one_of_each(docs, distance=3, shingle=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts; every document stays."""
    return secret_scan.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are replicated to their target weights and shuffled."""
    return mixing.mix(docs, temperature=0.5, epochs=1.0, seed="mix")


STAGES = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("secret_scan", secrets),
    ("source_mixing", mixture),
]

#: A conditional random field and a sampled-bit search take part; SQL cannot say them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = work_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
