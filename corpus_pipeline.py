"""Corpus pipeline: STAGES over ``documents``; each stage's result is written as Parquet and read by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orderlake.llm import stages
from orderlake.session import discard, stored

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", stages.language),
    ("lines", stages.lines),
    ("near_duplicates", stages.near_duplicates),
    ("decontamination", stages.decontamination),
    ("mixing", stages.source_mix),
]

#: SQL has no BK-tree, n-gram filter or SimHash; the stages are tested one by one against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stage's files are deleted once the next stage's are written; those of the last one stay."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        before, docs = docs, stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        discard(before)
    return docs
