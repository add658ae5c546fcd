"""A vector index that lives in tables: coarse cells, residual codes of one byte a component, exact re-ranking, and an exact search that skips cells.

Vectors are compared by cosine, so unit vectors are indexed.  Cell centres are fitted by k-means on a bounded sample; every usable row is then put
into its nearest cell.  A part (one per batch) has the table ``codes`` (what is left of a vector beside its cell's centre, in steps of the cell's
largest component) and the table ``rows`` (the vectors themselves), both sorted by cell, and ``cells`` with the number of vectors of each cell
and the widest angle to its centre.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.windows import top_per_key
from tidewatch.session import cut_lineage
from tidewatch.sources.manifest import Manifest

#: Steps of a residual code to either side.
STEPS = 127
#: Queries that the number of cells to read is set by, their neighbours, and the share of these that must lie in the cells read.
TRIALS, TRIAL_NEIGHBOURS, TRIAL_SHARE = 64, 10, 0.98


@dataclass
class Near:
    """Neighbours (id, cosine), nearest first, and how many cells the index has and how many were read."""

    rows: DataFrame
    cells: int
    read: int


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, v: acc + v)


def unit(vector: Column) -> Column:
    """The vector at length one; null where it is null, empty, zero, or holds a null or a component that is not finite."""
    wide = vector.cast("array<double>")
    norm = F.sqrt(_dot(wide, wide))
    return F.when((F.size(wide) > 0) & (norm > 0) & (norm < float("inf")), F.transform(wide, lambda x: x / norm))


class VectorIndex:
    """The index under ``root``.  ``cells`` is the number of cells, ``sample`` the rows at most that their centres are fitted on (by the order of a
    hash of the id); all other work covers every row."""

    def __init__(self, spark: SparkSession, root: str, *, cells: int = 64, sample: int = 50_000, seed: int = 17):
        self.spark, self.root, self.cells, self.sample, self.seed = spark, root.rstrip("/"), cells, sample, seed
        self.manifest = Manifest(spark, self.root)

    # ---- writing ----

    def add(self, vectors: DataFrame, id_col: str, vector_col: str) -> None:
        """Index a batch of new ids.  The first batch with usable vectors also fits the cells; rows without a usable vector are left out, like
        those whose length is not that of the cells."""
        version, parts = self.manifest.read()
        rows = cut_lineage(vectors.select(F.col(id_col).alias("id"), unit(F.col(vector_col)).alias("v")).filter("v is not null"))
        centres = self._table(parts, "centres")
        part: dict = {"name": f"part-{uuid.uuid4().hex}"}
        where = f"{self.root}/{part['name']}"
        if centres is None:
            centres = self._fitted(rows)
            if centres is None:
                return
            centres.write.parquet(f"{where}/centres")
            part["centres"] = True
            centres = self.spark.read.parquet(f"{where}/centres")
        placed = cut_lineage(self._placed(rows, centres))
        if "centres" in part:
            part["probe"] = self._tried(placed, centres)
        gap = F.zip_with("v", "centre", lambda x, c: x - c)
        facts = placed.groupBy("cell").agg(F.count("*").alias("n"), F.min("cosine").alias("least"),
                                           F.max(F.array_max(F.transform(gap, F.abs))).alias("scale"))
        facts.write.parquet(f"{where}/cells")
        scales = self.spark.read.parquet(f"{where}/cells").select("cell", "scale")
        codes = placed.join(F.broadcast(scales), "cell")  # a row per cell
        code = F.transform(gap, lambda g: F.when(F.col("scale") > 0, F.round(g / F.col("scale") * STEPS)).otherwise(0).cast("tinyint"))
        for name, table in (("codes", codes.select("cell", "id", code.alias("code"))), ("rows", placed.select("cell", "id", "v"))):
            table.repartitionByRange("cell", "id").sortWithinPartitions("cell", "id").write.parquet(f"{where}/{name}")
        self.manifest.publish(version + 1, [*parts, part])

    def _fitted(self, rows: DataFrame) -> DataFrame | None:
        """(cell, centre): k-means over the sample, centres at length one."""
        size = rows.orderBy(F.xxhash64("id"), "id").select(F.size("v").alias("n")).limit(1).collect()
        if not size:
            return None
        some = rows.filter(F.size("v") == size[0].n).orderBy(F.xxhash64("id"), "id").limit(self.sample).select(array_to_vector("v").alias("features"))
        model = KMeans(k=self.cells, seed=self.seed, maxIter=15).fit(cut_lineage(some.select(vector_to_array("features").alias("v"))).select(
            array_to_vector("v").alias("features")))
        found = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
        return self.spark.createDataFrame(found, "cell int, centre array<double>").withColumn("centre", unit(F.col("centre"))).filter("centre is not null")

    def _tried(self, placed: DataFrame, centres: DataFrame) -> int:
        """How many cells, nearest first, hold TRIAL_SHARE of the neighbours of trial queries.  Neighbours are looked for in the sample, so those in
        all rows are nearer."""
        some = cut_lineage(placed.orderBy(F.xxhash64("id"), "id").limit(self.sample).select("id", "v", "cell"))
        queries = some.orderBy(F.xxhash64("id", F.lit(self.seed)), "id").limit(TRIALS).collect()
        dots = F.array(*[_dot(F.col("v"), F.lit(list(q.v))) for q in queries])
        near = top_per_key(some.select("id", "cell", F.posexplode(dots).alias("query", "cosine")), ["query"], [F.desc("cosine"), F.asc("id")], TRIAL_NEIGHBOURS + 1)
        found = near.filter("rank > 1").select("query", "cell").collect()  # the first is the query itself
        middle = [(c.cell, c.centre) for c in centres.collect()]
        ranks = []
        for i, q in enumerate(queries):
            order = sorted(middle, key=lambda c: -sum(x * y for x, y in zip(c[1], q.v)))
            place = {cell: n for n, (cell, _) in enumerate(order, 1)}
            ranks += [place[r.cell] for r in found if r.query == i]
        ranks.sort()
        return ranks[min(len(ranks) - 1, int(TRIAL_SHARE * len(ranks)))] if ranks else 1

    def _placed(self, rows: DataFrame, centres: DataFrame) -> DataFrame:
        """Rows with cell, centre and the cosine between; the centres are one array, so rows are not multiplied."""
        all_centres = centres.groupBy().agg(F.sort_array(F.collect_list(F.struct("cell", "centre"))).alias("a")).first().a  # as many as cells
        table = F.array(*[F.struct(F.lit(c.cell).alias("cell"), F.lit(list(c.centre)).alias("centre")) for c in all_centres])
        best = F.array_max(F.transform(table, lambda c: F.struct(_dot(F.col("v"), c["centre"]).alias("cosine"), (-c["cell"]).alias("minus"), c["centre"].alias("centre"))))
        size = len(all_centres[0].centre)
        return rows.filter(F.size("v") == size).withColumn("best", best).select(
            "id", "v", (-F.col("best.minus")).alias("cell"), "best.centre", "best.cosine")

    # ---- reading ----

    def _table(self, parts: list[dict], name: str) -> DataFrame | None:
        paths = [f"{self.root}/{p['name']}/{name}" for p in parts if name != "centres" or p.get("centres")]
        return self.spark.read.parquet(*paths) if paths else None

    def _cells(self, parts: list[dict], query: list[float]) -> list:
        """All cells with what can be said of them before they are read: the cosine to the centre and the largest cosine to any vector inside."""
        facts = self._table(parts, "cells").groupBy("cell").agg(F.sum("n").alias("n"), F.min("least").alias("least"))
        near = _dot(F.col("centre"), F.lit(query))
        rows = facts.join(self._table(parts, "centres"), "cell").select("cell", "n", "least", near.alias("near")).collect()  # a row per cell

        def bound(r) -> float:
            between = math.acos(max(-1.0, min(1.0, r.near))) - math.acos(max(-1.0, min(1.0, r.least)))
            return math.cos(max(0.0, between)) + 2e-6
        return sorted(((r.near, bound(r), r.cell, r.n) for r in rows), key=lambda c: (-c[0], c[2]))

    def _query(self, vector) -> list[float]:
        norm = math.sqrt(sum(float(x) * float(x) for x in vector))
        if not 0 < norm < float("inf"):
            raise ValueError("a query needs a direction")
        return [float(x) / norm for x in vector]

    def _exact(self, parts: list[dict], query: list[float], cells: list[int]) -> DataFrame:
        rows = self._table(parts, "rows").filter(F.col("cell").isin(cells))
        return rows.select("id", F.round(_dot(F.col("v"), F.lit(query)), 6).alias("cosine"))

    def search(self, vector, k: int = 10, probe: int | None = None, refine: int = 4) -> Near:
        """About the nearest: the codes of the ``probe`` nearest cells (by default as many as the trials asked for) give ``refine * k`` candidates, whose
        vectors decide."""
        parts, query = self.manifest.read()[1], self._query(vector)
        probe = probe or max(p.get("probe", 1) for p in parts)
        cells = self._cells(parts, query)
        chosen = [c[2] for c in cells[:probe]]
        to_centre = F.create_map(*[F.lit(x) for c in cells[:probe] for x in (c[2], c[0])])
        # Codes of a part are in steps of the part's own cell, so they are scaled part by part.
        every = None
        for part in parts:
            scale = {r.cell: r.scale for r in self._table([part], "cells").filter(F.col("cell").isin(chosen)).collect()}
            if not scale:
                continue
            step = F.create_map(*[F.lit(x) for cell, s in scale.items() for x in (cell, s / STEPS)])
            codes = self._table([part], "codes").filter(F.col("cell").isin(list(scale)))
            some = codes.select("cell", "id", (to_centre[F.col("cell")] + step[F.col("cell")] * _dot(F.col("code"), F.lit(query))).alias("about"))
            every = some if every is None else every.unionByName(some)
        best = cut_lineage(every.orderBy(F.desc("about"), "id").limit(refine * k).select("cell", "id"))
        rows = self._table(parts, "rows").filter(F.col("cell").isin(chosen)).join(best, ["cell", "id"])
        found = rows.select("id", F.round(_dot(F.col("v"), F.lit(query)), 6).alias("cosine")).orderBy(F.desc("cosine"), "id").limit(k)
        return Near(found, len(cells), len(chosen))

    def search_exactly(self, vector, k: int = 10, probe: int = 8) -> Near:
        """The nearest: after the ``probe`` nearest cells only those are read that can hold a vector as near as the k-th."""
        parts, query = self.manifest.read()[1], self._query(vector)
        cells = self._cells(parts, query)
        order = [F.desc("cosine"), F.asc("id")]
        first = cut_lineage(self._exact(parts, query, [c[2] for c in cells[:probe]]).orderBy(*order).limit(k))
        state = first.agg(F.count("*").alias("n"), F.min("cosine").alias("least")).first()
        more = [c[2] for c in cells[probe:] if state.n < k or c[1] >= state.least]
        rows = first.unionByName(self._exact(parts, query, more)) if more else first
        return Near(rows.orderBy(*order).limit(k), len(cells), len(cells[:probe]) + len(more))
