"""Training-corpus pipeline: five stages, each written as Parquet and reread."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stockroute.llm import stages
from stockroute.session import scratch_path

STAGES = [
    ("quality_rules", stages.quality),
    ("near_dedup", stages.near_duplicates),
    ("pii_redaction", stages.redact),
    ("source_mix", stages.mix),
    ("bpe", stages.tokenise),
]

#: The stages after the first are beyond SQL; tests hold them to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
