"""Sharding by a Feistel permutation of global row numbers.

Row numbers come from a range sort; the permuted number p gives shard p % shards and slot p // shards.  So counts differ by at
most one, slots have no gaps, and both can be computed from (row number, row count, seed) alone, in either direction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import common, feistel


def shard(docs: DataFrame, shards: int, seed: str = "shuffle") -> DataFrame:
    """The columns of ``docs`` with row_number, shard and slot.

    Rows are numbered by doc_id (null first), then the checksum and hash of the text, so the order does not follow the layout of the
    files; rows equal in all of these are interchangeable.  Null texts and null ids are rows like others, an empty table gives no rows, and
    columns of the input named like a result are replaced.
    """
    keep = common.fresh(docs, "row_number", "shard", "slot")
    text = common.whole(F.col("text"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col("doc_id").alias("k1"),
                       F.crc32(F.encode(text, "UTF-8")).alias("k2"), F.xxhash64(text).alias("k3"))
    if "text" not in keep:
        raise ValueError("text is one of the input's columns")
    return _placed(*common.numbered(rows, ["k1", "k2", "k3"], "row_number"), shards, seed)


def _placed(rows: DataFrame, n: int, shards: int, seed: str) -> DataFrame:
    place = feistel.permuted(F.col("row_number"), n, seed)
    return (rows.withColumn("__place", place)
            .select("row.*", "row_number", F.expr(f"cast(__place % {shards} as int)").alias("shard"),
                    F.expr(f"__place div {shards}").alias("slot")))


def shard_keys(docs: DataFrame, shards: int, seed: str = "shuffle") -> DataFrame:
    """Like ``shard`` for doc_id, the size in bytes and the checksum only: the text is not moved."""
    text = common.whole(F.col("text"))
    crc = F.crc32(F.encode(text, "UTF-8"))
    rows = docs.select(F.struct(F.col("doc_id"), F.octet_length(text).cast("bigint").alias("bytes"), crc.alias("text_crc32")).alias("row"),
                       F.col("doc_id").alias("k1"), crc.alias("k2"), F.xxhash64(text).alias("k3"))
    return _placed(*common.numbered(rows, ["k1", "k2", "k3"], "row_number"), shards, seed)


def query(spark, sf_dir: str) -> DataFrame:
    placed = shard_keys(common.table(spark, sf_dir, "documents"), 40)
    return placed.select("doc_id", (F.col("bytes") + 16).alias("size"), "text_crc32", F.lit("rows").alias("law"),
                         "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
