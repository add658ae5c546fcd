"""Session settings for tests and the benchmark, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: str | int | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A local session; on a cluster the session comes from the submitter."""
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("tidewatch")
             .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.skewJoin.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.execution.arrow.pyspark.enabled", "true")
             .config("spark.driver.memory", "12g")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session that names none gets a temporary one.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tidewatch-"))
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write a table once to the shared folder and read it back.

    It is then computed once however often it is read, survives the loss of
    executors, and, being parquet, is read only in the columns a consumer needs.
    """
    path = f"{shared_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_rows(spark: SparkSession, most: int) -> Iterator[None]:
    """What runs inside sends ``most`` rows at a time to Python; Spark and the worker hold whole batches, so long texts need short ones."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if not 0 < int(before) <= most:  # no positive number: no limit
        spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.set(name, before)
