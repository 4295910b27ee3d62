"""The corpus pipeline: stages over the table of documents.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet in the session's shared folder and read again as the next
stage's documents, so a lost executor costs at most one stage's tasks and a
failed run keeps what its earlier stages wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthly_facts.llm import decontam, fertility, mixing, near_dedup, sharding
from monthly_facts.llm.tables import OWN, table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie in their language's band."""
    return fertility.judged(docs).where(F.col(OWN + "kept")).select(*docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The lowest document of each class of near duplicates."""
    return near_dedup.unique_documents(docs, every_shingle=True)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every source near its target; a document stays as often as it is taken."""
    return mixing.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the shard of each document."""
    return sharding.sharded(docs)


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("sharding", shard),
]
# Tokenizers, sketches and clustering are not SQL; tests/llm holds the run
# against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
