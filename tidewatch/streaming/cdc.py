"""Change feed to SCD type 2, incrementally.

Layout under ``root``:

* ``versions/batch=N/open=false``: versions closed by batch N, never rewritten
* ``versions/batch=N/open=true/bucket=B``: open versions of the keys of batch N, and of no others; of a key's open
  versions the one of the newest batch is valid
* ``base/batch=N``: the valid open versions after batch N, written now and then, so that a reader needs only the batches since
* ``late/batch=N``: changes older than the open version of their key
* ``merged``: closed versions and late changes of whole stretches of batches, in segments that are merged by size, with a list of the valid ones

A batch reads the open versions of the buckets it touches and the new changes, and writes rows for its own keys only.
Late changes are kept beside the history and woven in by the reader, for the keys concerned only.

When a base is written, the batches up to it are merged into a segment, and folders that the base before covers are removed.  A reader so
lists the batches since that one and about ``fanout * log(n)`` segments, and a closed version is rewritten about log(n) times.  The newest batch can still
be run again: what it reads is older than the newest base, and that is kept.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.history import followed
from tidewatch.params import Params
from tidewatch.sources.manifest import Manifest
from tidewatch.streaming import batches

FEED = "entity_key bigint, lsn bigint, changed_at timestamp_ntz, state string, change_type string"
VERSION = FEED + ", valid_to timestamp_ntz"
STORED = VERSION + ", batch int, bucket int"
_COLS = ["entity_key", "lsn", "changed_at", "state", "change_type"]


def _open_versions(spark: SparkSession, root: str, done: list[int], buckets: list[int] | None = None) -> DataFrame:
    """The valid open version of every key, or of the keys of some buckets."""
    bases = [b for b in batches.finished(spark, f"{root}/base") if done and b <= done[-1]][-1:]
    since = [b for b in done if not bases or b > bases[0]]
    stored = batches.get(spark, f"{root}/versions", STORED, since, "/open=true").unionByName(batches.get(spark, f"{root}/base", STORED, bases))
    if buckets is not None:
        stored = stored.filter(F.col("bucket").isin(buckets))
    version = F.struct(*_COLS, "valid_to")
    return stored.groupBy("entity_key").agg(F.max_by(version, F.col("batch")).alias("v")).select("v.*")


def _segments(spark: SparkSession, root: str) -> tuple[int, list[dict], int]:
    """Version and segments of the merged batches, and the last batch among them (-1 for none)."""
    version, parts = Manifest(spark, f"{root}/merged").read()
    return version, parts, max((p["to"] for p in parts), default=-1)


def _settled(spark: SparkSession, root: str, parts: list[dict], done: list[int]) -> tuple[DataFrame, DataFrame]:
    """Closed versions and late changes of some segments and batches."""
    closed = batches.get(spark, f"{root}/versions", VERSION, done, "/open=false")
    late = batches.get(spark, f"{root}/late", FEED, done)
    if parts:
        names = [f"{root}/merged/{p['name']}" for p in parts]
        closed = closed.unionByName(spark.read.schema(VERSION).parquet(*[f"{n}/closed" for n in names]))
        late = late.unionByName(spark.read.schema(FEED).parquet(*[f"{n}/late" for n in names]))
    return closed, late


class HistoryWriter:
    """Writes one micro-batch; every ``compact_every``-th one also writes a base and merges what came before."""

    def __init__(self, root: str, p: Params, buckets: int = 64, compact_every: int = 50, fanout: int = 4):
        self.root, self.p, self.buckets, self.compact_every, self.fanout = root, p, buckets, compact_every, fanout

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # read by three jobs
        try:
            self._write(batch, batch_id)
        finally:
            batch.unpersist()

    def _write(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        bucket = F.pmod(F.xxhash64("entity_key"), F.lit(self.buckets)).cast("int")
        # At most one small number per bucket comes back to the driver.
        touched = [r.b for r in batch.select(bucket.alias("b")).distinct().collect()]
        before = [b for b in batches.finished(spark, f"{self.root}/versions") if b < batch_id]
        new = batch.select(*_COLS)
        old = (_open_versions(spark, self.root, before, touched).select(*_COLS)
               .join(new.select("entity_key").distinct(), "entity_key", "left_semi"))
        marked = new.join(old.select("entity_key", F.col("lsn").alias("open_lsn")), "entity_key", "left")
        batches.put(marked.filter(F.col("lsn") < F.col("open_lsn")).select(*_COLS), f"{self.root}/late", batch_id)
        fresh = marked.filter(F.col("open_lsn").isNull() | (F.col("lsn") > F.col("open_lsn"))).select(*_COLS)
        led = followed(old.unionByName(fresh), self.p)
        rows = led.select(*_COLS, "valid_to", F.col("next_lsn").isNull().alias("open"), bucket.alias("bucket"))
        batches.put(rows.repartition("bucket"), f"{self.root}/versions", batch_id, partition_by=("open", "bucket"))
        if batch_id % self.compact_every == self.compact_every - 1:
            whole = _open_versions(spark, self.root, [*before, batch_id])
            batches.put(whole.withColumn("bucket", bucket).repartition("bucket"), f"{self.root}/base", batch_id, partition_by=("bucket",))
            self._settle(spark, [*before, batch_id])

    def _settle(self, spark: SparkSession, done: list[int]) -> None:
        """Merge the batches that no segment has, and remove what the base before the newest one covers."""
        version, parts, to = _segments(spark, self.root)
        if to < done[-1]:
            parts = [*parts, self._merged(spark, [], [b for b in done if b > to], 0, done[-1])]
            for tier in range(max(p["tier"] for p in parts) + 1):
                same = [p for p in parts if p["tier"] == tier]
                if len(same) >= self.fanout:
                    parts = [p for p in parts if p["tier"] != tier] + [self._merged(spark, same, [], tier + 1, max(p["to"] for p in same))]
            manifest = Manifest(spark, f"{self.root}/merged")
            manifest.publish(version + 1, parts)
            # A reader may still follow the list before; segments that neither names go.
            named = {p["name"] for p in parts} | {p["name"] for p in manifest.read_version(version)}
            manifest.forget(keep=2)
            for folder in manifest.folders():
                if folder not in named:
                    manifest.remove(folder)
        bases = [b for b in batches.finished(spark, f"{self.root}/base") if b < done[-1]]
        # The batch of that base stays too, so that a repeated batch finds both whatever ``compact_every`` is.
        for table in ("versions", "late", "base") if bases else ():
            batches.remove_up_to(spark, f"{self.root}/{table}", bases[-1] - 1)

    def _merged(self, spark: SparkSession, parts: list[dict], done: list[int], tier: int, to: int) -> dict:
        name = f"segment-{uuid.uuid4().hex}"
        closed, late = _settled(spark, self.root, parts, done)
        closed.repartitionByRange("entity_key").sortWithinPartitions("entity_key", "lsn").write.parquet(f"{self.root}/merged/{name}/closed")
        late.repartitionByRange("entity_key").sortWithinPartitions("entity_key", "lsn").write.parquet(f"{self.root}/merged/{name}/late")
        return {"name": name, "tier": tier, "to": to}


def stream_history(feed: DataFrame, root: str, checkpoint: str, p: Params, buckets: int = 64, compact_every: int = 50) -> None:
    batches.run_available(feed, HistoryWriter(root, p, buckets, compact_every), checkpoint)


def read_history(spark: SparkSession, root: str, p: Params) -> DataFrame:
    """All versions with validity intervals; the same rows as the batch job gives."""
    done = batches.finished(spark, f"{root}/versions")
    _, parts, to = _segments(spark, root)
    closed, late = _settled(spark, root, parts, [b for b in done if b > to])
    closed = closed.withColumn("is_current", F.lit(False))
    opened = _open_versions(spark, root, done).withColumn("is_current", F.lit(True))
    stored = closed.unionByName(opened)
    touched = late.select("entity_key").distinct()
    rows = stored.join(touched, "entity_key", "left_semi").select(*_COLS).unionByName(late)
    redone = followed(rows, p).withColumn("is_current", F.col("next_lsn").isNull()).drop("next_lsn")
    whole = stored.join(touched, "entity_key", "left_anti").unionByName(redone)
    return whole.filter(F.col("change_type") != "delete").select(
        "entity_key", "lsn", "state", F.col("changed_at").alias("valid_from"), "valid_to", "is_current")


def read_latest(spark: SparkSession, root: str) -> DataFrame:
    """Newest state per key: the open versions."""
    opened = _open_versions(spark, root, batches.finished(spark, f"{root}/versions"))
    return opened.filter(F.col("change_type") != "delete").select("entity_key", "lsn", "state", "changed_at")
