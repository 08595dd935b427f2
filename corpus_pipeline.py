"""From raw documents to shards of training data, in five stages.

Each stage is a function (spark, docs, sf_dir) to a DataFrame; what it returns is
written as Parquet and read again as the next one's documents. All but the last return
the columns of the documents they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tierstone.llm import decontaminate, hash_tree, language, mixing, simhash
from tierstone.llm.common import stored, table

SHARDS = 24


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model knows; the others go."""
    return language.accepted(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not made of benchmark passages."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled towards the weights of sources, languages and topics, each at most
    once: what a value cannot deliver that way is raked to the others."""
    return mixing.sampled(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard of each document and its place there."""
    return hash_tree.shard_documents(docs, hash_tree.regular_tree(SHARDS))


STAGES = [
    ("language", known_language),
    ("near_duplicates", one_of_each),
    ("decontamination", uncontaminated),
    ("mixing", mixed),
    ("sharding", sharded),
]

#: The first stage is a trained model, so SQL cannot tell the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
