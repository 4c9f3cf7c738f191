"""Queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from casework.llm import ann, bpe, lines, minhash, packing, pii, prefix_trie, quality, repair, shards, simhash, substrings, token_store
from casework.llm.common import tokenizer_path
from casework.session import table_path


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.token_table(_read(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_table(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_read(spark, sf_dir, "documents"))


def op4_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.sharded_table(_read(spark, sf_dir, "documents"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_table(_read(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_table(_read(spark, sf_dir, "documents"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(_read(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_table(_read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest_table(_read(spark, sf_dir, "embeddings"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.fingerprint_table(_read(spark, sf_dir, "documents"))


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeat_table(_read(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie_table(_read(spark, sf_dir, "conversations"))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_table(_read(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_token_store, op2_quality, op3_simhash, op4_shards, op5_bpe, op6_line_dedup, op7_pii,
                            op8_packing, op9_nearest, op10_minhash, op11_substring_dedup, op12_prefix_trie,
                            op13_repair)}
ORACLE = {"op6_line_dedup": lines.LINES_SQL, "op9_nearest": ann.NEAREST_SQL, "op12_prefix_trie": prefix_trie.TRIE_SQL}
