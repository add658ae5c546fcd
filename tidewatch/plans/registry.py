"""Catalog of named queries, each with the SQL that must give the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.plans.lake import Lake
from tidewatch.plans.views import SQL_VIEWS

QUERIES: dict[str, Callable[[Lake], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return add


def edge(df: DataFrame) -> DataFrame:
    """Decimals leave the engine as doubles."""
    return df.select(*[
        F.col(f"`{f.name}`").cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
        else F.col(f"`{f.name}`") for f in df.schema.fields])


def runner(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return edge(QUERIES[name](Lake(spark, sf_dir)))
    run.__name__ = name
    return run


def _needed(sql: str, found: dict[str, None]) -> None:
    for name in SQL_VIEWS:
        if name not in found and re.search(rf"\b(FROM|JOIN)\s+{name}\b", sql):
            _needed(SQL_VIEWS[name], found)
            found[name] = None


def full_sql(name: str) -> str:
    """The query's SQL with the views it reads spelled out in a WITH clause."""
    found: dict[str, None] = {}
    _needed(SQL[name], found)
    if not found:
        return SQL[name]
    with_clause = ",\n".join(f"{v} AS ({SQL_VIEWS[v].strip()})" for v in found)
    body = SQL[name].strip()
    if re.match(r"WITH\b", body, re.IGNORECASE):
        return f"WITH {with_clause},\n{body[4:].strip()}"
    return f"WITH {with_clause}\n{body}"
