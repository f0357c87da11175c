"""Documents to training shards: quality, near-duplicates, benchmark leaks, source mix, shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wattloom.llm import attention, mixing, ring, simhash, tiling
from wattloom.llm.common import stored, table


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it is fitted on the labelled ones among them."""
    return attention.accepted(docs, attention.fit(docs, table(spark, sf_dir, "labels")))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.one_of_each(docs)


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return tiling.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; repeated documents are repeated rows."""
    return mixing.mixed_documents(docs)


def sharded_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix dealt to shards, with shard and slot."""
    return ring.shard_documents(docs)


STAGES = [
    ("quality classifier", good_documents),
    ("simhash near-dedup", distinct_documents),
    ("benchmark decontamination", clean_documents),
    ("mixing sources", mixed_documents),
    ("sharding", sharded_documents),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)


# The classifier's learned weights have no SQL form; tests compare every stage with a plain version.
ORACLE_SQL = None
