"""What the operators share: words, global row numbers, table access."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewatch.session import cut_lineage

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(col: Column) -> Column:
    """A text, null as the empty one."""
    return F.coalesce(col.cast("string"), F.lit(""))


def words(col: Column) -> Column:
    return F.filter(F.split(whole(col), SPACE), lambda w: w != "")


def n_words(col: Column) -> Column:
    """Pieces between white space, without the empty ones at either end."""
    def count(parts: Column) -> Column:
        first, last = F.element_at(parts, 1) == "", (F.size(parts) > 1) & (F.element_at(parts, -1) == "")
        return (F.size(parts) - first.cast("int") - last.cast("int")).cast("bigint")
    return bind(F.split(whole(col), SPACE), count)


def bind(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it is named there."""
    return F.element_at(F.transform(F.array(value), use), 1)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The frame's columns whose names the operator does not give to its own results."""
    mine = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in mine]


def ranged(df: DataFrame, order: list[str]) -> DataFrame:
    """The rows in range-sorted order, written once with their range (``__part``) and place (``__at``): a recomputed task cannot shift them.

    Rows that tie in ``order`` come in any order.
    """
    at = F.monotonically_increasing_id()  # range in the upper bits, place in the range in the lower 33
    return cut_lineage(df.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order)
                       .withColumn("__at", at).withColumn("__part", F.shiftright("__at", 33)))


def earlier_parts(rows: DataFrame, value: Column) -> tuple[DataFrame, int]:
    """(__part, __before): the sum of ``value`` in earlier ranges, and the total.  A row per range, of which there are as many as
    shuffle partitions; so one task may sum them up, and the table may be broadcast."""
    parts = cut_lineage(rows.groupBy("__part").agg(F.sum(value.cast("bigint")).alias("__sum")))
    total = parts.agg(F.sum("__sum")).first()[0] or 0
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select("__part", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__before")), total


def numbered(df: DataFrame, order: list[str], name: str) -> tuple[DataFrame, int]:
    """Rows with the number of rows before them in ``order``, and the number of all rows; one shuffle."""
    rows = ranged(df, order)
    parts, total = earlier_parts(rows, F.lit(1))
    place = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    return rows.join(F.broadcast(parts), "__part").withColumn(name, F.col("__before") + place).drop("__at", "__part", "__before"), total


def summed_before(rows: DataFrame, value: str, name: str) -> tuple[DataFrame, int]:
    """``ranged`` rows with the sum of ``value`` over all rows before them, and the total; shuffles the rows by range."""
    parts, total = earlier_parts(rows, F.col(value))
    inside = Window.partitionBy("__part").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    local = rows.withColumn("__local", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return local.join(F.broadcast(parts), "__part").withColumn(name, F.col("__before") + F.col("__local")).drop("__before", "__local"), total
