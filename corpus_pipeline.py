"""The corpus pipeline: quality rules, near-dedup, benchmark decontamination, mixture, shards.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the next one's documents.  All but the
last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import common, decontaminate, minhash, mixing, rules, sharding
from tidewatch.session import shared_dir

SHARDS = 40


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without their failing lines."""
    return rules.cleaned(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: shingles of five words, similarity of 0.8 or more."""
    return minhash.deduplicated(docs, minhash.Likeness(words=5, percent=80))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_leaks(docs, common.table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture by source weights: documents repeat with their source's epochs; the one at a source's cut is taken whole or left out."""
    return mixing.materialised(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with row_number, shard and slot."""
    return sharding.shard(docs, SHARDS)


STAGES = [("quality rules", quality), ("near-dedup", near_dedup), ("decontamination", decontamination), ("mixture", mixture), ("sharding", shards)]

#: The latent search of the third stage has no SQL; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and reread."""
    docs = common.table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = f"{shared_dir(spark)}/stage-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
