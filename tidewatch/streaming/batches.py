"""Replay-safe output of micro-batches.

Each micro-batch owns the directory ``batch=<id>`` of a table and overwrites
it, so a batch that is run again after a failure leaves the same rows.  Readers
take a batch only when its write finished.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def put(df: DataFrame, root: str, batch_id: int, *, partition_by: tuple[str, ...] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{root}/batch={batch_id}")


def children(spark: SparkSession, root: str) -> list[str]:
    """Names of the partition directories under a directory that may not exist."""
    p = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if "=" in s.getPath().getName()) if fs.exists(p) else []


def finished(spark: SparkSession, root: str) -> list[int]:
    """Ids of the batches whose write was completed."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(int(n[6:]) for n in children(spark, root) if fs.exists(path(f"{root}/{n}/_SUCCESS")))


def get(spark: SparkSession, root: str, schema: str, batches: list[int] | None = None, sub: str = "") -> DataFrame:
    """All finished batches of a table, or the given ones.

    ``sub`` names one partition directory inside each batch; a batch may lack it.
    """
    ids = finished(spark, root) if batches is None else batches
    path = spark._jvm.org.apache.hadoop.fs.Path
    dirs = [f"{root}/batch={b}{sub}" for b in ids]
    conf = spark._jsc.hadoopConfiguration()
    dirs = [d for d in dirs if path(d).getFileSystem(conf).exists(path(d))]
    empty = spark.createDataFrame([], schema)
    # Directory names below the base read as partition columns; only declared columns are kept.
    return spark.read.schema(schema).option("basePath", root).parquet(*dirs).select(*empty.columns) if dirs else empty


def remove_up_to(spark: SparkSession, root: str, last: int) -> None:
    """Remove the batches of a table up to a given one; a batch is unfinished before its rows go."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    for name in children(spark, root):
        if int(name[6:]) <= last:
            fs.delete(path(f"{root}/{name}/_SUCCESS"), False)
            fs.delete(path(f"{root}/{name}"), True)


def run_available(stream: DataFrame, apply, checkpoint: str, mode: str = "append") -> None:
    """Process everything that is there, batch by batch, and stop."""
    q = (stream.writeStream.outputMode(mode).foreachBatch(apply).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def file_stream(spark: SparkSession, path: str, schema, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def total(df: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    """Add up partial rows of several batches."""
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])
