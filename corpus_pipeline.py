"""A training corpus from raw documents: language, near-duplicates, repeated passages, benchmark
passages, tokens.  Every stage's result is a table that the next one reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from snapledger.llm import stages
from snapledger.llm.common import Scratch

STAGES = [
    ("language", stages.language),
    ("near_duplicates", stages.near_duplicates),
    ("repeated_passages", stages.repeated_passages),
    ("decontamination", stages.decontamination),
    ("tokens", stages.tokens),
]

#: Neither compression nor fingerprints nor merges can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``.  A stage's table goes once the next is written."""
    scratch = Scratch(spark, "pipeline")
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
        if before:
            scratch.drop(before)
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)
