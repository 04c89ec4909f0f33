"""From raw documents to packed training sequences: quality, exact copies, near copies, mixture, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from annoframe.llm import digest_index, mixing, packing, quality, similar
from annoframe.llm.common import documents, removed, stored_at


def good_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return digest_index.keep_one(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return similar.keep_one(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs).drop("ids")


STAGES = [("quality", good_texts), ("exact_dedup", exact_copies), ("near_dedup", near_copies), ("mixing", mixture), ("packing", packed)]

#: Quality models and shingle similarity are no SQL; tests/llm compares every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; a stage's table is deleted once the next one is written."""
    docs, last = documents(spark, sf_dir), None
    for name, stage in STAGES[:-1]:
        docs, path = stored_at(stage(spark, docs, sf_dir), name)
        if last:
            removed(spark, last)
        last = path
    out = STAGES[-1][1](spark, docs, sf_dir)  # has stored what it needs
    removed(spark, last)
    return out
