"""A training corpus from the documents table, in five stages.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage
before it kept:

1. language ID: rows in no learned language go (no letter, or hardly like any)
2. near-dedup: one row of each MinHash near-duplicate class of texts stays
3. decontamination: rows that hold a benchmark item go
4. mixing: sources are replicated to equal weights and shuffled
5. sharding: near-equal byte shards and slots are added to the columns

SQL cannot express the learned first stage, so there is no oracle;
tests/llm/test_pipeline.py holds each stage against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetreports.llm import decontaminate, language_id, mixing, near_dedup, sharding
from fleetreports.llm.tables import stored


def _language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.in_known_language(docs)


def _near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one(docs)


def _decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def _mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, marks=False)


def _shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard(docs)


STAGES = [
    ("language_id", _language),
    ("near_dedup", _near_dedup),
    ("decontaminate", _decontaminate),
    ("mix", _mix),
    ("shard", _shard),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; between stages the rows are a table in the
    shared checkpoint folder, so no stage is computed twice."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
