"""The latest row of every key at any day, without a pass over the history.

Level 0 of the store holds the given rows, by day.  Level l holds the latest row of each key in every closed window of ``width ** l`` days, so the days
up to any date are a few windows of each level: single days since the last window of the first level, windows of that since the last of the second, and
so on.  They are read level by level, newest first, and older ones only for the keys not found yet; once all keys that are known by then are found,
nothing older is read.  A history of n days takes ``width * log(n)`` windows at most, and a row is copied once a level at most.

Nothing is lost: the rows of level 0 stay, any date can be asked for, and late rows rebuild the windows they fall in.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.session import cut_lineage
from tidewatch.sources.manifest import Manifest

_EPOCH = date(1970, 1, 1).toordinal()


@dataclass
class Latest:
    """The rows, and the windows that were read for them as (level, window)."""

    rows: DataFrame
    read: list[tuple[int, int]]


class LatestStore:
    """The store under ``root`` for rows of ``schema`` with a ``key`` and a ``day`` (a date).

    Rows whose key or day is null are left out.  Of several rows of a key on one day the largest by the other columns counts, so the result does not
    depend on the order of writing.  Above level 0 a window is split by a hash of the key into ``buckets`` folders, of which only those of missing keys are read.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, key: str, day: str, *, width: int = 8, buckets: int = 16):
        if width < 2:
            raise ValueError("a window holds at least two windows of the level below")
        self.spark, self.root, self.schema, self.key, self.day = spark, root.rstrip("/"), schema, key, day
        self.width, self.buckets = width, buckets
        self.manifest = Manifest(spark, self.root)

    # ---- writing ----

    def add(self, rows: DataFrame, batch: str | None = None) -> None:
        """Add rows of any days.  A batch whose name the store already has is left out, so a writer that died may repeat it."""
        version, parts = self.manifest.read()
        if batch is not None and any(p["batch"] == batch for p in parts):
            return
        rows = rows.select(*self.schema.names).filter(F.col(self.key).isNotNull() & F.col(self.day).isNotNull())
        new = self._write(rows, 0, batch)
        parts = [*parts, *new, *self._write_keys(new, parts, batch)]
        days = [p["window"] for p in parts if p["level"] == 0]
        level, touched = 0, {p["window"] for p in new}
        while days:
            level += 1
            closed = (max(days) + 1) // self.width ** level
            below = {p["window"] // self.width for p in parts if p["level"] == level - 1}
            if not any(w < closed for w in below):
                break
            stale = {w // self.width for w in touched}
            have = {p["window"] for p in parts if p["level"] == level}
            touched = {w for w in below if w < closed and (w not in have or w in stale)}
            if touched:
                children = [p for p in parts if p["level"] == level - 1 and p["window"] // self.width in touched]
                parts = [p for p in parts if p["level"] != level or p["window"] not in touched]
                parts += self._write(self._read(children), level, None)
        self.manifest.publish(version + 1, parts)

    def _write(self, rows: DataFrame, level: int, batch: str | None) -> list[dict]:
        """Write the windows of a level in one job and list them; above level 0 a window keeps the latest row of a key."""
        window = F.floor(F.unix_date(self.day) / self.width ** level).cast("int")
        rows = rows.withColumn("_window", window)
        if level:
            rows = rows.groupBy(self.key, "_window").agg(F.max(self._ranked()).alias("_r")).select(self.key, "_r.*", "_window")
        name = f"level{level}-{uuid.uuid4().hex}"
        split = ("_window", "_bucket") if level else ("_window",)
        (rows.select(*self.schema.names, "_window", *([self._bucket()] if level else [])).repartition(*split).sortWithinPartitions(*split, self.key)
         .write.partitionBy(*split).parquet(f"{self.root}/{name}"))
        # The windows are read off the folders' names; they are as many as the days of a batch.
        found = [int(f.split("=")[1]) for f in Manifest(self.spark, f"{self.root}/{name}").folders() if f.startswith("_window=")]
        return [{"level": level, "window": w, "name": name, "batch": batch} for w in found]

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int").alias("_bucket")

    def _ranked(self) -> Column:
        """What decides between the rows of a key."""
        return F.struct(self.day, *[c for c in self.schema.names if c not in (self.key, self.day)])

    def _write_keys(self, new: list[dict], parts: list[dict], batch: str | None) -> list[dict]:
        """The first day of keys that are new, or that a late row makes older."""
        if not new:
            return []
        firsts = self._read(new).groupBy(self.key).agg(F.min(self.day).alias("first"))
        known = self._keys(parts)
        if known is not None:
            firsts = firsts.join(known.withColumnRenamed("first", "known"), self.key, "left").filter("known IS NULL OR first < known").drop("known")
        name = f"keys-{uuid.uuid4().hex}"
        firsts.write.parquet(f"{self.root}/{name}")
        return [{"level": -1, "window": 0, "name": name, "batch": batch}]

    def vacuum(self) -> None:
        """Remove what no list names any more: windows that late rows rebuilt, and writes that died.  No writer may be at work."""
        named = {p["name"] for p in self.manifest.read()[1]}
        self.manifest.forget()
        for folder in self.manifest.folders():
            if folder not in named:
                self.manifest.remove(folder)

    # ---- reading ----

    def _keys(self, parts: list[dict]) -> DataFrame | None:
        paths = [f"{self.root}/{p['name']}" for p in parts if p["level"] == -1]
        schema = T.StructType([self.schema[self.key], T.StructField("first", T.DateType())])
        return self.spark.read.schema(schema).parquet(*paths).groupBy(self.key).agg(F.min("first").alias("first")) if paths else None

    def _read(self, parts: list[dict], buckets: list[int] | None = None) -> DataFrame:
        """The rows of some windows, whose folders are named one by one, so the others are not even listed."""
        frames = []
        for name in sorted({p["name"] for p in parts}):
            folder, level = f"{self.root}/{name}", next(p["level"] for p in parts if p["name"] == name)
            stored = T.StructType([*self.schema.fields, *([T.StructField("_bucket", T.IntegerType())] if level else [])])
            df = self.spark.read.schema(stored).option("basePath", folder).parquet(*[f"{folder}/_window={p['window']}" for p in parts if p["name"] == name])
            frames.append((df.filter(F.col("_bucket").isin(buckets)) if level and buckets is not None else df).select(*self.schema.names))
        return reduce(DataFrame.unionByName, frames)

    def _windows(self, parts: list[dict], day: date) -> list[list[dict]]:
        """The windows that make up all days up to ``day``, by level, newest first."""
        days = [p["window"] for p in parts if p["level"] == 0]
        if not days:
            return []
        end, top = min(day.toordinal() - _EPOCH, max(days)) + 1, max(p["level"] for p in parts)
        out = []
        for level in range(top + 1):
            start = end // self.width * self.width
            out.append([p for p in parts if p["level"] == level and p["window"] < end and (level == top or p["window"] >= start)])
            end //= self.width
        return [group for group in out if group]

    def at(self, day: date) -> Latest:
        """The latest row up to ``day`` of every key that has one.  Runs a job or two per level that is read."""
        _, parts = self.manifest.read()
        empty = self.spark.createDataFrame([], self.schema)
        keys = self._keys(parts)
        if keys is None:
            return Latest(empty, [])
        missing = cut_lineage(keys.filter(F.col("first") <= F.lit(day)).select(self.key, self._bucket()))
        found, read, buckets = [], [], None
        for group in self._windows(parts, day):
            if found:
                # One small number per bucket.
                buckets = [r[0] for r in missing.select("_bucket").distinct().collect()]
                if not buckets:
                    break
            rows = self._read(group, buckets)
            if found:
                rows = rows.join(missing.select(self.key), self.key, "left_semi")
            rows = rows.groupBy(self.key).agg(F.max(self._ranked()).alias("_r")).select(self.key, "_r.*").select(*self.schema.names)
            found.append(cut_lineage(rows))
            read += [(p["level"], p["window"]) for p in group]
            missing = cut_lineage(missing.join(found[-1].select(self.key), self.key, "left_anti"))
        return Latest(reduce(DataFrame.unionByName, found, empty), sorted(set(read)))
