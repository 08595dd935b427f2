"""The operators of this subpackage as queries over one folder of test tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tierstone.llm import (
    chunk_dedup, conversations, decontaminate, fingerprints, hard_negatives, hash_tree, language, mixing, neighbours, quality, simhash, token_files, toxicity,
)
from tierstone.llm.common import table

SHARDS = 24

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_hash_tree(spark, sf_dir):
    return hash_tree.shard_documents(table(spark, sf_dir, "documents"), hash_tree.regular_tree(SHARDS))


@query
def op2_language(spark, sf_dir):
    return language.identify(table(spark, sf_dir, "documents"))


@query
def op3_simhash(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return found.select("doc_id", hexed, "component_id")


@query
def op4_chunk_dedup(spark, sf_dir):
    """Every passage that a document shares with another one."""
    return chunk_dedup.repeats(table(spark, sf_dir, "documents")).drop("row_a")


@query
def op5_mixing(spark, sf_dir):
    found = mixing.mix(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "source", "lang", F.col("__topic").alias("topic"), F.col("__tokens").alias("tokens"),
        F.round("__weight", 6).alias("weight"), F.col("__copies").alias("copies"),
    )


@query
def op6_neighbours(spark, sf_dir):
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


@query
def op7_resampling(spark, sf_dir):
    return quality.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op8_token_files(spark, sf_dir):
    manifest = token_files.write(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    schema = pa.schema([("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
    return token_files.read_files(manifest, token_files.count_and_checksum, "n_tokens long, ids_crc32 long", schema)


@query
def op9_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_decontamination(spark, sf_dir):
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), "contaminated",
    )


@query
def op11_hard_negatives(spark, sf_dir):
    return hard_negatives.mine(
        hard_negatives.relabelled(table(spark, sf_dir, "embeddings")), F.col("vec_id") % 50 == 0
    )


@query
def op12_auction_repair(spark, sf_dir):
    damaged, dropped = conversations.damage(table(spark, sf_dir, "conversations"))
    return conversations.repair(damaged, dropped=dropped)


@query
def op13_minhash(spark, sf_dir):
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


@query
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)


ORACLES: dict[str, str] = {
    "op1_hash_tree": hash_tree.oracle(SHARDS),
    "op5_mixing": mixing.oracle(),
    "op11_hard_negatives": hard_negatives.oracle(),
    "op12_auction_repair": conversations.oracle(),
    "op13_minhash": fingerprints.oracle(),
}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
