"""The measure cube as a table that changes keep up to date.

A refresh takes the position rows of the subscribers that changed.  The store knows what each subscriber last gave to the cube; a changed row takes that back
and adds its new partials, so a batch gives a few signed cells.  The cube is the sum of all signed cells, and a group without rows has left it.
Batches are segments that are merged by size, so a cube of n batches is read from about ``fanout * log(n)`` small tables.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.operators import metrics
from tidewatch.sources.manifest import Manifest

_N = "_n_"  # prefix of the number of rows that gave a partial, since a sum over none is NULL and not 0


class CubeStore:
    """The cube under ``root`` over position rows of ``schema``, one per ``key``.

    Rows without a key are left out; of several rows of a key in one batch the largest counts.  What subscribers gave is kept by a hash of the key in
    ``buckets`` folders, and a refresh reads those of the changed keys only.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, key: str = "subscriber_id", *, buckets: int = 64, fanout: int = 4):
        self.spark, self.root, self.key, self.buckets, self.fanout = spark, root.rstrip("/"), key, buckets, fanout
        self.manifest = Manifest(spark, self.root)
        self.dims, self.partials = list(metrics.CUBE_DIMENSIONS), metrics._partials(metrics.MEASURES)
        empty = spark.createDataFrame([], schema)
        self._given = self._contributions(empty).schema
        self._cells = self._sums(self._contributions(empty), F.lit(1)).schema

    def _contributions(self, rows: DataFrame) -> DataFrame:
        return rows.select(self.key, *self.dims, *[e().alias(n) for n, e in self.partials.items()])

    def _sums(self, given: DataFrame, sign: Column) -> DataFrame:
        """Signed cells of contributions."""
        rows = given.withColumn("_sign", sign.cast("bigint"))

        def signed(n: str) -> Column:
            value = F.coalesce(F.col(n), F.lit(0).cast(given.schema[n].dataType))
            return F.when(F.col("_sign") > 0, value).otherwise(-value)
        return rows.groupBy(*self.dims).agg(
            F.sum("_sign").alias("_rows"), *[F.sum(signed(n)).cast(self._wide(given.schema[n].dataType)).alias(n) for n in self.partials],
            *[F.sum(F.when(F.col(n).isNotNull(), F.col("_sign")).otherwise(0)).alias(_N + n) for n in self.partials])

    @staticmethod
    def _wide(kind: T.DataType) -> T.DataType:
        """The type of a sum, as the rebuilt cube has it.  Sums of floats cannot be taken back exactly."""
        if isinstance(kind, T.DecimalType):
            return T.DecimalType(min(38, kind.precision + 10), kind.scale)
        if not isinstance(kind, T.IntegralType):
            raise TypeError(f"partials are whole numbers or decimals, not {kind.simpleString()}")
        return T.LongType()

    # ---- writing ----

    def refresh(self, changed: DataFrame, gone: DataFrame | None = None, batch: str | None = None) -> list[int]:
        """Take in the new rows of changed keys, and the keys that are ``gone``.  Returns the buckets that were read.

        A batch whose name the store already has is left out, so a writer that died may repeat it.  A key that is in both frames has changed.
        """
        version, parts = self.manifest.read()
        if batch is not None and any(batch in p["batches"] for p in parts):
            return []
        seq = max((p["seq"] for p in parts), default=0) + 1
        after = self._contributions(changed).withColumn("_live", F.lit(True))
        if gone is not None:
            after = after.unionByName(gone.select(self.key).withColumn("_live", F.lit(False)), allowMissingColumns=True)
        names = self._given.names[1:]
        after = (after.filter(F.col(self.key).isNotNull()).groupBy(self.key).agg(F.max(F.struct("_live", *names)).alias("_r"))
                 .select(self.key, "_r.*", F.lit(seq).alias("_seq"), F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int").alias("_bucket")))
        part = {"name": f"cube-{uuid.uuid4().hex}", "tier": 0, "seq": seq, "batches": [] if batch is None else [batch]}
        where = f"{self.root}/{part['name']}"
        after.repartition("_bucket").sortWithinPartitions("_bucket", self.key).write.partitionBy("_bucket").parquet(f"{where}/rows")
        # The touched buckets are read off the folders' names.
        touched = sorted(int(f.split("=")[1]) for f in Manifest(self.spark, f"{where}/rows").folders() if f.startswith("_bucket="))
        new = self._rows([part])
        signed = new.filter("_live").withColumn("_sign", F.lit(1))
        if parts and touched:
            before = self._newest(self._rows(parts, touched).join(new.select(self.key), self.key, "left_semi")).filter("_live")
            signed = signed.unionByName(before.withColumn("_sign", F.lit(-1)))
        self._write_cells(self._sums(signed.drop("_live", "_seq", "_bucket"), F.col("_sign")), where)
        self.manifest.publish(version + 1, self._tiered([*parts, part]))
        return touched

    def _write_cells(self, cells: DataFrame, where: str) -> None:
        """Cells whose changes cancel out are not kept."""
        some = reduce(lambda a, b: a | b, [F.col(c) != 0 for c in cells.columns if c not in self.dims])
        cells.filter(some).write.parquet(f"{where}/cells")

    def _tiered(self, parts: list[dict]) -> list[dict]:
        for tier in range(max(p["tier"] for p in parts) + 1):
            same = [p for p in parts if p["tier"] == tier]
            if len(same) >= self.fanout:
                rest = [p for p in parts if p["tier"] != tier]
                parts = [*rest, self._merged(same, tier + 1, oldest=not rest)]
        return parts

    def _merged(self, parts: list[dict], tier: int, oldest: bool) -> dict:
        """One segment of several.  The newest row of a key stays; a key that is gone is forgotten when nothing older could come back."""
        out = {"name": f"cube-{uuid.uuid4().hex}", "tier": tier, "seq": max(p["seq"] for p in parts), "batches": [b for p in parts for b in p["batches"]]}
        rows = self._newest(self._rows(parts))
        rows = (rows.filter("_live") if oldest else rows).withColumn("_bucket", F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int"))
        where = f"{self.root}/{out['name']}"
        rows.repartition("_bucket").sortWithinPartitions("_bucket", self.key).write.partitionBy("_bucket").parquet(f"{where}/rows")
        self._write_cells(self._added(parts), where)
        return out

    def vacuum(self) -> None:
        """Remove what no list names any more: merged segments and writes that died.  No writer may be at work."""
        named = {p["name"] for p in self.manifest.read()[1]}
        self.manifest.forget()
        for folder in self.manifest.folders():
            if folder not in named:
                self.manifest.remove(folder)

    # ---- reading ----

    def _rows(self, parts: list[dict], buckets: list[int] | None = None) -> DataFrame:
        """What subscribers gave, in some buckets; a segment may hold several versions of a key, one a segment."""
        extra = [T.StructField("_live", T.BooleanType()), T.StructField("_seq", T.IntegerType()), T.StructField("_bucket", T.IntegerType())]
        schema = T.StructType([*self._given.fields, *extra])
        df = reduce(DataFrame.unionByName, [self.spark.read.schema(schema).parquet(f"{self.root}/{p['name']}/rows") for p in parts])
        return df if buckets is None else df.filter(F.col("_bucket").isin(buckets))

    def _newest(self, rows: DataFrame) -> DataFrame:
        newest = F.max_by(F.struct(*self._given.names[1:], "_live", "_bucket"), F.col("_seq")).alias("_r")
        return rows.groupBy(self.key).agg(newest, F.max("_seq").alias("_seq")).select(self.key, "_r.*", "_seq")

    def _added(self, parts: list[dict]) -> DataFrame:
        """The sum of the segments' cells."""
        cells = self.spark.read.schema(self._cells).parquet(*[f"{self.root}/{p['name']}/cells" for p in parts])
        sums = [f for f in self._cells.fields if f.name not in self.dims]
        return cells.groupBy(*self.dims).agg(*[F.sum(f.name).cast(f.dataType).alias(f.name) for f in sums])

    def cube(self) -> DataFrame:
        """The same rows as ``metrics.metric_cube`` over the whole position."""
        _, parts = self.manifest.read()
        cells = self._added(parts) if parts else self.spark.createDataFrame([], self._cells)
        return cells.filter("_rows > 0").select(*self.dims, *[F.when(F.col(_N + n) > 0, F.col(n)).alias(n) for n in self.partials])


def changed_rows(before: DataFrame, after: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The rows of ``after`` that are new or differ, and the keys of ``before`` that are gone, for sources that do not name their changes."""
    columns = [c for c in after.columns if c != key]
    old = before.select(key, F.struct(*columns).alias("_old"), F.lit(True).alias("_known"))
    changed = after.join(old, key, "left").filter(F.col("_known").isNull() | ~F.struct(*columns).eqNullSafe(F.col("_old"))).select(*after.columns)
    return changed, before.select(key).join(after.select(key), key, "left_anti")
