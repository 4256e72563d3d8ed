"""The corpus pipeline: documents through filtering, deduplication, decontamination, mixing and sharding."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from obslake.llm import decontaminate, mixing, ngram_join, sharding, toxicity
from obslake.llm.queries import table
from obslake.session import cut_lineage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that are not predicted to be toxic."""
    return toxicity.remove_toxic(docs, table(spark, sf_dir, "labels"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: shingles of five words, a similarity of 0.8 or more."""
    return ngram_join.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that are not contaminated by the benchmark."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each row as often as it is taken, with the columns of documents."""
    return mixing.mix_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of every row of the mix."""
    return sharding.shard_table(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", clean),
    ("n-gram Jaccard join", without_near_copies),
    ("benchmark decontamination", decontaminated),
    ("mixing", mix),
    ("sharding", shard),
]

# The cube method draws, and components are walks of any length: there is no SQL for the rows of run().
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over ``documents``, each written as Parquet to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
