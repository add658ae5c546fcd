"""Serving mirrors: keyed, versioned parquet snapshots of gold tables.

A published version is an immutable directory ``v=N``; readers use the highest
complete one, so a failed or repeated publish never disturbs them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.text import to_number
from tidewatch.params import BANDS, OFFER_TYPES

RANKING = T.ArrayType(T.StructType([
    T.StructField("offerType", T.StringType()), T.StructField("costUsd", T.DoubleType()),
    T.StructField("predictedRetainedClvUsd", T.DoubleType()), T.StructField("predictedNetValueUsd", T.DoubleType())]))


def coerce_band(col: Column) -> Column:
    """Unknown or missing bands become healthy."""
    return F.when(col.isin(*BANDS), col).otherwise(F.lit("healthy"))


def coerce_offer(col: Column) -> Column:
    """Unknown offers become NULL."""
    return F.when(col.isin(*OFFER_TYPES), col)


def parse_ranking(raw: Column) -> Column:
    """The ranking array of a JSON text; anything but a well-formed array becomes empty."""
    is_array = raw.rlike(r"^\s*\[[\s\S]*\]\s*$")
    parsed = F.from_json(F.when(is_array, raw), RANKING, {"mode": "PERMISSIVE"})
    return F.coalesce(parsed, F.array().cast(RANKING))


def numeric_cells(df: DataFrame, cols) -> DataFrame:
    """Pair every string column with a numeric one that is set for clean numbers only."""
    return df.select("*", *[to_number(F.col(c)).alias(f"{c}_num") for c in cols])


def merged(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Insert if absent: existing rows win, the rest is added; one row per key."""
    new = incoming.join(existing.select(key), key, "left_anti").dropDuplicates([key])
    return existing.unionByName(new)


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def current_version(spark: SparkSession, root: str) -> int:
    """Highest version that was written to the end; 0 when there is none."""
    p, fs = _fs(spark, root)
    if not fs.exists(p):
        return 0
    jpath = spark._jvm.org.apache.hadoop.fs.Path
    done = [int(s.getPath().getName()[2:]) for s in fs.listStatus(p)
            if s.getPath().getName().startswith("v=") and fs.exists(jpath(s.getPath(), "_SUCCESS"))]
    return max(done, default=0)


def read_mirror(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    v = current_version(spark, root)
    return spark.read.schema(schema).parquet(f"{root}/v={v}") if v else spark.createDataFrame([], schema)


def publish(incoming: DataFrame, root: str, key: str, *, force: bool = False, rebuild: bool = False) -> int:
    """Write the next version if the mirror is empty, or if forced.

    ``force`` adds missing keys to what is there; ``rebuild`` starts over from
    the incoming rows.  Returns the version readers now see.
    """
    spark = incoming.sparkSession
    v = current_version(spark, root)
    if v and not (force or rebuild) and not read_mirror(spark, root, incoming.schema).isEmpty():
        return v
    old = read_mirror(spark, root, incoming.schema)
    rows = incoming.dropDuplicates([key]) if rebuild else merged(old, incoming, key)
    rows.write.mode("overwrite").parquet(f"{root}/v={v + 1}")
    return v + 1


def reset(incoming: DataFrame, root: str, key: str, action_log: str, action_schema: T.StructType) -> int:
    """Empty the action log and rebuild the mirror."""
    spark = incoming.sparkSession
    spark.createDataFrame([], action_schema).write.mode("overwrite").parquet(action_log)
    return publish(incoming, root, key, rebuild=True)


def publish_jdbc(df: DataFrame, url: str, table: str, *, batch_rows: int = 2000, **options) -> None:
    """Append to a database table in batches of ``batch_rows``."""
    df.write.format("jdbc").options(url=url, dbtable=table, batchsize=str(batch_rows), **options).mode("append").save()
