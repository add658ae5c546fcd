"""Per-key ordered computations that survive a hot key.

A plain window sends all rows of a key to one task.  Here a key with more than
``hot_rows`` rows is cut into segments of consecutive sequence numbers; each
segment is an ordinary window group and only one small row per segment is
carried to its neighbours.  All other keys stay in segment 0 and take the plain
path, so the extra work is proportional to the hot part only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.session import cut_lineage

SEGMENT = "segment__"


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int) -> DataFrame:
    """Keys with more than ``hot_rows`` rows, from a scan of the key columns alone.

    The list is written, because two joins read it; its size decides at run time whether it is broadcast.
    """
    return cut_lineage(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n__"))
                       .filter(F.col("n__") > hot_rows).select(*keys, F.lit(True).alias("hot__")))


def _cut(seq: str, hot_rows: int):
    return (F.floor(F.col(seq) / hot_rows) + 1).cast("bigint")


def with_segments(df: DataFrame, hot: DataFrame, keys: list[str], seq: str, hot_rows: int) -> DataFrame:
    """Add the segment column: 0 for ordinary keys, a range of the sequence for hot ones."""
    segment = F.when(F.col("hot__"), _cut(seq, hot_rows)).otherwise(F.lit(0).cast("bigint"))
    return (df.join(hot, keys, "left")
            .withColumn(SEGMENT, segment).drop("hot__"))


def _hot_rows_only(df: DataFrame, hot: DataFrame, keys: list[str], seq: str, hot_rows: int) -> DataFrame:
    """The rows of hot keys with their segment.

    An inner join: when no key is hot, the empty list lets Spark drop this
    branch, and the join that uses it, at run time.
    """
    return (df.join(hot, keys, "inner")
            .withColumn(SEGMENT, _cut(seq, hot_rows)).drop("hot__"))


def neighbour(df: DataFrame, keys: list[str], seq: str, cols: dict[str, str], hot_rows: int,
              forward: bool) -> DataFrame:
    """``lead`` (forward) or ``lag`` of columns within keys, ordered by the sequence.

    Rows with equal keys and sequence are neighbours and share a segment.
    """
    order = Window.partitionBy(*keys, SEGMENT).orderBy(seq)
    step = F.lead if forward else F.lag
    hot = hot_keys(df, keys, hot_rows)
    inner = with_segments(df, hot, keys, seq, hot_rows).select(
        "*", *[step(c).over(order).alias(n) for n, c in cols.items()],
        step(F.lit(True)).over(order).alias("inside__"))
    # One edge row per segment of a hot key: its first (lead) or last (lag) values.
    edge = (F.min_by if forward else F.max_by)(F.struct(*cols.values()), F.col(seq))
    target = F.lag if forward else F.lead
    edges = (_hot_rows_only(df, hot, keys, seq, hot_rows).groupBy(*keys, SEGMENT).agg(edge.alias("edge__"))
             .select(*keys, target(SEGMENT).over(Window.partitionBy(*keys).orderBy(SEGMENT)).alias(SEGMENT), "edge__")
             .filter(F.col(SEGMENT).isNotNull()))
    joined = inner.join(edges, [*keys, SEGMENT], "left")
    return joined.select(*df.columns, *[
        F.when(F.col("inside__"), F.col(n)).otherwise(F.col(f"edge__.{c}")).alias(n)
        for n, c in cols.items()])


def running_totals(df: DataFrame, keys: list[str], seq: str, totals: dict[str, str],
                   hot_rows: int) -> DataFrame:
    """Running sums within keys in sequence order, current row included."""
    order = Window.partitionBy(*keys, SEGMENT).orderBy(seq).rowsBetween(Window.unboundedPreceding, 0)
    hot = hot_keys(df, keys, hot_rows)
    inner = with_segments(df, hot, keys, seq, hot_rows).select(
        "*", *[F.sum(c).over(order).alias(n) for n, c in totals.items()])
    before = Window.partitionBy(*keys).orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    carried = (_hot_rows_only(df, hot, keys, seq, hot_rows).groupBy(*keys, SEGMENT)
               .agg(*[F.sum(c).alias(f"{n}__t") for n, c in totals.items()])
               .select(*keys, SEGMENT, *[F.sum(f"{n}__t").over(before).alias(f"{n}__c") for n in totals]))
    joined = inner.join(carried, [*keys, SEGMENT], "left")
    return joined.select(*df.columns, *[
        (F.col(n) + F.coalesce(F.col(f"{n}__c"), F.lit(0))).alias(n) for n in totals])


def top_per_key(df: DataFrame, keys: list[str], order: list, k: int, rank: str = "rank") -> DataFrame:
    """First k rows of each key.

    The filter on ``row_number`` lets Spark keep only k rows per key in every
    map task before the shuffle, so a hot key sends k rows per task.
    """
    return (df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
            .filter(F.col(rank) <= k))
