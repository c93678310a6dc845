"""From raw documents to balanced shards of a training mix, each stage by an operator of orderlens.llm."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import decontamination, mixing, quality, sharding, simhash
from orderlens.session import remove, scratch, shared_folder


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group that fingerprints link: shingles of 3 words, 3 bits or fewer apart."""
    return simhash.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their size, checksum, shard and slot."""
    placed = sharding.shard(docs)
    added = ["size", "text_crc32", "shard", "slot"]
    return placed.select(*(F.col("row").getField(c).alias(c) for c in docs.columns if c not in added), *added)


STAGES = [
    ("quality rules", good_documents),
    ("near-dedup", one_of_each),
    ("benchmark decontamination", without_benchmark),
    ("mixing sources", mixed),
    ("sharding", sharded),
]

# Fingerprints, n-gram models and the draws of the mix have no SQL form; tests/llm checks the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each stage's result is written and read again as the next one's documents, then the tables
    that made it, and its predecessor, are removed."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES, 1):
        path = f"{folder}/stage-{number}"
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if number > 1:
            remove(spark, f"{folder}/stage-{number - 1}")
    return docs
