"""Exact distinct counts that can be rolled up and added to, as bitmaps.

A cube row holds one dimension group's ids of one range of 32,768 numbers, a bit each (4 KB, which the parquet codec shrinks where few are set).  Coarser
groups and further batches are bitwise ORs of these, so a count never goes back to the base table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bitmap_cube(rows: DataFrame, dims: list[str], id_col: str) -> DataFrame:
    """(dims, id_range, bits) for whole-number ids of any sign; null ids do not count, so a group of null ids only has no row."""
    number = F.col(id_col).cast("bigint")
    placed = rows.filter(number.isNotNull()).select(*dims, F.bitmap_bucket_number(number).alias("id_range"), F.bitmap_bit_position(number).alias("place"))
    return placed.groupBy(*dims, "id_range").agg(F.bitmap_construct_agg("place").alias("bits"))


def added(*cubes: DataFrame) -> DataFrame:
    """One cube of several with the same dimensions, as those of batches."""
    rows = reduce(DataFrame.unionByName, cubes)
    return rows.groupBy(*[c for c in rows.columns if c != "bits"]).agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_from_cube(cube: DataFrame, dims: list[str], name: str = "n_distinct") -> DataFrame:
    """Distinct ids by some of the cube's dimensions; without any, one row."""
    per_range = cube.groupBy(*dims, "id_range").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
    return per_range.groupBy(*dims).agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias(name))
