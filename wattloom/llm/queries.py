"""The operators as queries over their whole tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wattloom.llm import attention, blocks, collocations, forest, merkle, mixing, noisychannel, prefixbpe, ring, simhash, suffixes, tiling, tokenfile
from wattloom.llm.common import table


def op1_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ring.digest(table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.report(table(spark, sf_dir, "documents"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op4_noisy_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return noisychannel.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_block_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.extracted(table(spark, sf_dir, "pages"))


def op6_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_elias_fano(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.report(table(spark, sf_dir, "documents"))


def op9_passage_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return attention.scored(docs, attention.fit(docs, table(spark, sf_dir, "labels")))


def op10_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.neighbours(table(spark, sf_dir, "embeddings"))


def op11_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return prefixbpe.digest(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.best(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ring_shards,
        op2_suffix_dedup,
        op3_mix_sources,
        op4_noisy_channel,
        op5_block_field,
        op6_string_tiling,
        op7_elias_fano,
        op8_simhash,
        op9_passage_attention,
        op10_prefix_forest,
        op11_prefix_bpe,
        op12_phrases,
        op13_merkle_manifest,
    )
}

ORACLES: dict[str, str] = {
    "op2_suffix_dedup": suffixes.ORACLE,
    "op3_mix_sources": mixing.ORACLE,
    "op10_prefix_forest": forest.ORACLE,
    "op12_phrases": collocations.ORACLE,
    "op13_merkle_manifest": merkle.ORACLE,
}
