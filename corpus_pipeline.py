"""A corpus pipeline: quality, line dedup, near-duplicates, personal data, packing.

Every stage works on what its predecessor kept, written as Parquet and read
again.  All but the last return the columns of ``documents``; ``n_chars``
follows the text where a stage changes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casework.llm import lines, packing, pii, quality, simhash
from casework.llm.common import tokenizer_path
from casework.session import table_path, write_table


def _counted(new: DataFrame, columns: list[str]) -> DataFrame:
    if "n_chars" in columns:
        new = new.withColumn("n_chars", F.length("text").cast("long"))
    return new.select(*columns)


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, quality.train(docs, spark.read.parquet(table_path(sf_dir, "labels"))))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(lines.dedup_lines(docs), docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(pii.redact(docs), docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed_table(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [("quality", good_documents), ("line_dedup", without_repeated_lines), ("simhash", one_of_each_group),
          ("pii", without_personal_data), ("packing", packed)]
ORACLE_SQL = None  # trained models, hashes and a tokenizer are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(table_path(sf_dir, "documents"))
    for name, stage in STAGES:
        docs = write_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
