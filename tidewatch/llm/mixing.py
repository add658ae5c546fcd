"""Mixing sources to target weights.

Rows get hash-random keys; the keys' leading digits are ranges of equal expected size.  Word counts are summed per source
and range, prefix sums over the ranges and then inside each range give every row the words before it, and a source is
cut exactly at its budget, after as many whole epochs as the budget holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewatch.llm import common
from tidewatch.session import cut_lineage

#: Hex digits of a key that name its range: 16 ** 3 ranges per source.
RANGE_DIGITS = 3


def cycled_weights(sources: DataFrame, cycle: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """(source, source_size) with weights by the rank of the source, null last.  One row per source, so the global window
    sees as many rows as the mixture has names."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    return sources.withColumn("weight", F.element_at(F.array(*map(F.lit, cycle)), (rank % len(cycle) + 1).cast("int")))


def water_filled(sources: DataFrame, cap: int = 3) -> DataFrame:
    """(source, source_size, weight) with ``target``: all words shared by weight, no source above ``cap`` times its size.

    With sources in the order of cap * size / weight, the level (words per unit of weight) left when the ones before are
    full rises as long as they do fill up and falls afterwards, so the wanted level is the largest.
    """
    full = F.col("source_size") * cap
    before = (Window.orderBy(full / F.col("weight"), F.col("source").asc_nulls_last())
              .rowsBetween(Window.unboundedPreceding, -1))
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum(full).over(before), F.lit(0))
    weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    return (sources.withColumn("__level", left / weight)
            .withColumn("target", F.least(full.cast("double"), F.col("weight") * F.max("__level").over(everything)))
            .drop("__level"))


def random_key(doc_id: Column, text: Column, seed: str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(common.whole(text))))


def mix(docs: DataFrame, carry: list[str], weights=cycled_weights, cap: int = 3, seed: str = "mix") -> DataFrame:
    """The ``carry`` columns of every row with size, source_size, target, epochs and taken.

    ``docs`` has doc_id, source and text.  ``epochs`` whole passes over a source are taken, then its rows in the order of
    their keys until the budget (the target, rounded) is spent; the row at the cut counts in part.  Null texts have size 0 and are
    taken 0 times; a null source is a source of its own; rows that share id and text (repeated rows) tie, and either may
    come first; an empty table gives no rows; further columns are ignored unless carried, and a carried column
    named like a result gives way to it.
    """
    carry = [c for c in carry if c.lower() not in {"size", "source_size", "target", "epochs", "taken"}]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col("source").cast("string").alias("source"),
        common.n_words(F.col("text")).alias("size"), random_key(F.col("doc_id"), F.col("text"), seed).alias("key"))
    rows = (rows.withColumn("range", F.substring("key", 1, RANGE_DIGITS))
            .withColumn("name", F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("="), F.col("source")))))
    if not any(c.lower() == "text" for c in carry):
        rows = cut_lineage(rows)  # narrow, and read twice
    ranges = cut_lineage(rows.groupBy("name", "source", "range").agg(F.sum("size").alias("words")))
    sources = ranges.groupBy("name", "source").agg(F.sum("words").alias("source_size"))
    targets = water_filled(weights(sources), cap).select("name", "source_size", "target")
    budget = F.floor(F.col("target") + 0.5).cast("bigint")
    ranges = ranges.withColumn("before", F.sum("words").over(Window.partitionBy("name").orderBy("range")) - F.col("words"))
    ranges = (ranges.join(targets, "name")
              .withColumn("epochs", F.when(F.col("source_size") > 0, F.expr("cast(floor(target + 0.5) as bigint) div source_size"))
                          .otherwise(F.lit(0).cast("bigint")))
              .withColumn("rest", budget - F.col("epochs") * F.col("source_size"))
              .select("name", "range", "before", "source_size", "target", "epochs", "rest"))
    inside = Window.partitionBy("name", "range").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("ahead", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(ranges, ["name", "range"])
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("before") - F.col("ahead")))
    return placed.select("row.*", "size", "source_size", "target", "epochs",
                         (F.col("epochs") * F.col("size") + part).alias("taken"))


def materialised(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """The mixture itself: the columns of ``docs``, each row as often as it is taken.

    Texts stay whole: the row at a source's cut is there once more if at least half of it is within the budget, else not, whichever ends nearer the
    target.  Rows without words belong to no budget and do not appear.
    """
    mixed = mix(docs, docs.columns, seed=seed)
    part = F.col("taken") - F.col("epochs") * F.col("size")
    copies = F.col("epochs") + F.when((part > 0) & (2 * part >= F.col("size")), 1).otherwise(0)
    mixed = mixed.filter((F.col("size") > 0) & (copies > 0)).withColumn("__copy", F.explode(F.sequence(F.lit(1), copies.cast("int"))))
    return mixed.select(*[F.col(f"`{c}`") for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return mix(docs, ["doc_id"]).select("doc_id", "size", "source_size", "target", "taken")


SQL = r"""
WITH sized AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
           md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS key
    FROM documents),
sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
    FROM sized GROUP BY source),
levels AS (
    SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER earlier, 0) AS DOUBLE)
              / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0) AS DOUBLE) AS level
    FROM sources
    WINDOW earlier AS (ORDER BY 3 * source_size / CAST(weight AS DOUBLE), source NULLS LAST
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
    SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE), weight * max(level) OVER ()) AS target FROM levels),
placed AS (
    SELECT s.doc_id, s.size, t.source_size, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS budget,
           coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.size
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0
            ELSE (budget // source_size) * size + greatest(0, least(size, budget % source_size - before)) END AS BIGINT) AS taken
FROM placed
"""
