"""Product codes of vectors by exact integer clustering.

Vectors become integers and are cut into parts; every part position has a codebook of its own, refined in rounds of nearest-entry assignment and
floored means.  All arithmetic is on integers, so the codes do not depend on how rows are dealt to tasks.

1. The parts of a position are sorted along a Hilbert curve, by ranges over the cluster, and packed into flat blocks of neighbours.  A block keeps
   its points, their smallest and largest components (its box) and their componentwise sum.
2. In each round the distances between box and entries leave a shortlist: an entry whose nearest point of the box is farther than the
   farthest point of the box is from another entry cannot win.  A block with one entry on its list gives its sum at once; the points
   of the others meet only their shortlist, in a small integer kernel.
3. Counts and sums per entry (as many as components in all codebooks) come back to the driver, which makes the next codebooks.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import common
from tidewatch.session import cut_lineage

#: Points of a block.
BLOCK = 256
#: A label with more than one in so many rows is hot; there are fewer hot ones than this.
HOT_SHARE = 1024


@dataclass(frozen=True)
class Coding:
    """Parts of a vector, entries of each codebook, rounds, and integers per unit."""

    parts: int = 8
    entries: int = 16
    rounds: int = 6
    scale: int = 4096

    def __post_init__(self):
        if not 1 <= self.entries <= 256 or self.parts < 1:
            raise ValueError("an entry is named by two hex digits, and there is at least one part")


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Places of points with ``bits`` bits a component along a Hilbert curve (Skilling's transform, all points at once)."""
    x = points.astype(np.int64).T.copy()
    top = 1 << (bits - 1)
    for q in (top >> i for i in range(bits - 1)):
        for axis in x:
            hit = (axis & q) != 0
            swap = np.where(hit, 0, (x[0] ^ axis) & (q - 1))
            x[0] ^= np.where(hit, q - 1, swap)
            axis ^= swap
    x = np.bitwise_xor.accumulate(x, 0)
    flip = np.zeros(x.shape[1], dtype=np.int64)
    for q in (top >> i for i in range(bits - 1)):
        flip ^= np.where(x[-1] & q, q - 1, 0)
    x ^= flip
    key = np.zeros(x.shape[1], dtype=np.int64)
    for bit in range(bits - 1, -1, -1):
        for axis in x:
            key = (key << 1) | ((axis >> bit) & 1)
    return key


def shortlists(low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Which entries may be nearest to a point of each box: (boxes, entries) booleans."""
    below, above = low[:, None, :] - entries, entries - high[:, None, :]
    nearest = (np.maximum(np.maximum(below, above), 0) ** 2).sum(-1)
    farthest = (np.maximum(np.abs(low[:, None, :] - entries), np.abs(high[:, None, :] - entries)) ** 2).sum(-1)
    return nearest <= farthest.min(1, keepdims=True)


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of the nearest entry, the lower index on ties."""
    gap = ((points[:, None, :] - entries) ** 2).sum(-1)
    best = gap.argmin(1)
    return best, gap[np.arange(len(points)), best]


# ---- blocks ----

_POINTS = "part int, key bigint, row bigint, point binary"
_BLOCKS = "part int, n int, rows binary, points binary, low array<bigint>, high array<bigint>, sums array<bigint>"


@dataclass(frozen=True)
class _Shape:
    """What all blocks have in common: components of a part, the integer type that holds them, and the range that the curve spans."""

    parts: int
    width: int
    kind: str
    low: int
    high: int

    @property
    def axes(self) -> int:
        return min(self.width, 60)

    @property
    def bits(self) -> int:
        return max(1, min(10, 60 // self.axes))


def _points(shape: _Shape):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            rows = batch.column(0).to_numpy()
            own = batch.column(1).flatten().to_numpy().astype(np.int64).reshape(len(batch), -1)
            whole = np.zeros((len(batch), shape.parts * shape.width), dtype=np.int64)
            whole[:, :own.shape[1]] = own
            for part in range(shape.parts):
                points = whole[:, part * shape.width:(part + 1) * shape.width]
                grid = (np.clip(points[:, :shape.axes], shape.low, shape.high) - shape.low) * ((1 << shape.bits) - 1) // max(1, shape.high - shape.low)
                packed = np.ascontiguousarray(points, dtype=shape.kind)
                size = packed.shape[1] * packed.itemsize
                point = pa.FixedSizeBinaryArray.from_buffers(pa.binary(size), len(rows), [None, pa.py_buffer(packed.tobytes())]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), part, np.int32)), pa.array(hilbert_keys(grid, shape.bits)),
                                                  pa.array(rows), point], names=["part", "key", "row", "point"])
    return run


def _packed(shape: _Shape):
    """Blocks of neighbours from rows sorted by part and key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in itertools.chain(batches, [None]):
            parts = [t for t in (held, batch and pa.Table.from_batches([batch])) if t is not None and len(t)]
            if not parts:
                continue
            table = pa.concat_tables(parts)
            part = table.column("part").to_numpy()
            starts = np.r_[0, np.flatnonzero(part[1:] != part[:-1]) + 1, len(part)]
            cuts = np.unique(np.concatenate([np.arange(a, b, BLOCK) for a, b in itertools.pairwise(starts.tolist())] + [[len(part)]]))
            if batch is not None:  # the last block may go on
                held, cuts = table.slice(int(cuts[-2])), cuts[:-1]
            else:
                held = None
            if len(cuts) < 2:
                continue
            end = int(cuts[-1])
            rows = table.column("row").to_numpy()[:end]
            flat = np.frombuffer(b"".join(table.column("point").slice(0, end).to_pylist()), dtype=shape.kind).reshape(end, -1).astype(np.int64)
            low, high, sums = (f.reduceat(flat, cuts[:-1], axis=0) for f in (np.minimum, np.maximum, np.add))
            spans = list(itertools.pairwise(cuts.tolist()))
            lists = [pa.array(list(x), pa.list_(pa.int64())) for x in (low, high, sums)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[cuts[:-1]].astype(np.int32)), pa.array(np.diff(cuts).astype(np.int32)),
                 pa.array([rows[a:b].astype(np.int64).tobytes() for a, b in spans], pa.binary()),
                 pa.array([flat[a:b].astype(shape.kind).tobytes() for a, b in spans], pa.binary()), *lists],
                names=["part", "n", "rows", "points", "low", "high", "sums"])
    return run


def _opened(batch: pa.RecordBatch, shape: _Shape, books: np.ndarray):
    """(part, count, sum, shortlist, points, row in the batch) of every block; the points only where the shortlist has several entries."""
    part, n = batch.column("part").to_numpy(), batch.column("n").to_numpy()
    low, high, sums = (batch.column(c).flatten().to_numpy().reshape(len(batch), -1) for c in ("low", "high", "sums"))
    points = batch.column("points")
    short = np.zeros((len(batch), books.shape[1]), dtype=bool)
    for p in np.unique(part):
        short[part == p] = shortlists(low[part == p], high[part == p], books[p])
    for i in range(len(batch)):
        listed = np.flatnonzero(short[i])
        yield int(part[i]), int(n[i]), sums[i], listed, lambda i=i: np.frombuffer(points[i].as_py(), dtype=shape.kind).reshape(-1, shape.width).astype(np.int64), i


def _round_sums(blocks: DataFrame, shape: _Shape, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(counts, sums) of the parts assigned to every entry."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(books.shape[:2], dtype=np.int64), np.zeros(books.shape, dtype=np.int64)
        for batch in batches:
            for part, n, total, listed, points, _ in _opened(batch, shape, books):
                if len(listed) == 1:
                    counts[part, listed[0]] += n
                    sums[part, listed[0]] += total
                    continue
                own = points()
                best = listed[nearest(own, books[part][listed])[0]]
                counts[part] += np.bincount(best, minlength=books.shape[1])
                np.add.at(sums[part], best, own)
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(counts[part, entry]),
                                          pa.array(list(sums[part, entry]), pa.list_(pa.int64()))], names=["part", "entry", "n", "sums"])
    found = blocks.select("part", "n", "points", "low", "high", "sums").mapInArrow(run, "part int, entry int, n bigint, sums array<bigint>")
    found = found.select("part", "entry", "n", F.posexplode("sums").alias("pos", "sum"))
    counts, sums = np.zeros(books.shape[:2], dtype=np.int64), np.zeros(books.shape, dtype=np.int64)
    for r in found.groupBy("part", "entry", "pos").agg(F.sum("n").alias("n"), F.sum("sum").alias("sum")).collect():  # parts x entries x width rows
        counts[r.part, r.entry], sums[r.part, r.entry, r.pos] = r.n, r["sum"]
    return counts, sums


def _assigned(blocks: DataFrame, shape: _Shape, books: np.ndarray) -> DataFrame:
    """(row, part, entry, error) of every part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("rows")
            for part, n, _, listed, points, i in _opened(batch, shape, books):
                best, error = nearest(points(), books[part][listed])
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(rows[i].as_py(), dtype=np.int64)), pa.array(np.full(n, part, np.int32)),
                                                  pa.array(listed[best].astype(np.int32)), pa.array(error)], names=["row", "part", "entry", "error"])
    return blocks.mapInArrow(run, "row bigint, part int, entry int, error bigint")


# ---- codes ----

def with_total(rows: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """``rows``, which are read twice, with the sum of ``value`` over the rows with an equal ``key`` (nulls together).  The sums of hot keys are few and
    broadcast, the others are joined by key."""
    totals = cut_lineage(rows.groupBy(F.col(key).alias("__key")).agg(F.sum(value).alias(name), F.count("*").alias("__n")))
    n = totals.agg(F.sum("__n")).first()[0] or 0
    hot = F.col("__n") * HOT_SHARE > n
    marked = rows.join(F.broadcast(totals.filter(hot).drop("__n")), F.col(key).eqNullSafe(F.col("__key")), "left").drop("__key")
    cold = totals.filter(~hot).drop("__n").withColumnRenamed(name, "__cold")
    rest = marked.filter(F.col(name).isNull()).drop(name).join(cold, F.col(key).eqNullSafe(F.col("__key")))
    return marked.filter(F.col(name).isNotNull()).unionByName(rest.withColumnRenamed("__cold", name).drop("__key"))


def integers(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component; null for a vector that is null, empty, or holds a null or a component that is not finite."""
    wide = vector.cast("array<double>")
    good = (F.size(wide) > 0) & F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(F.coalesce(good, F.lit(False)), F.transform(wide, lambda x: F.floor(x * scale).cast("bigint")))


def coded(vectors: DataFrame, coding: Coding = Coding()) -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks_sha256) of the usable rows of ``vectors`` (vec_id, embedding, label; further columns are
    ignored).

    A vector that is null, empty, or holds a null or non-finite component is dropped, and so is one whose length is not that of the vector with the
    smallest vec_id.  Lengths that are no multiple of the parts are filled up with zeros.  Codebooks start from the smallest vec_ids (null last, equal
    ones by vector); with fewer rows than entries they are smaller.  Rows with null or repeated vec_ids are coded like others.  ``error`` is the squared
    distance to the code's entries, ``label_error`` its sum over equal labels, nulls together.  An empty table gives no rows.  Raises ValueError
    where components are so large that errors do not fit 64 bits.
    """
    rows = vectors.select("vec_id", "label", integers(F.col("embedding"), coding.scale).alias("v")).filter("v is not null")
    rows = cut_lineage(rows.withColumn("row", F.monotonically_increasing_id()))
    order = [F.asc_nulls_last("vec_id"), F.asc("v")]
    first = rows.orderBy(*order).limit(1).collect()
    if not first:
        none = vectors.select("vec_id", "label").limit(0)
        return none.select("vec_id", "label", F.lit("").alias("code"), *[F.lit(0).cast("bigint").alias(c) for c in ("error", "label_error")],
                           F.lit("").alias("codebooks_sha256"))
    size = len(first[0].v)
    rows = rows.filter(F.size("v") == size)
    width = -(-size // coding.parts)
    total = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double"))
    squares = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    facts = rows.agg(F.min(F.array_min("v")).alias("low"), F.max(F.array_max("v")).alias("high"), F.sum(total).alias("s"), F.sum(squares).alias("q"),
                     F.count("*").alias("n")).first()
    largest = max(abs(facts.low), abs(facts.high)) + 1
    if 4 * largest * largest * width * coding.parts >= 1 << 63:
        raise ValueError("components are too large for exact errors in 64 bits")
    mean = facts.s / (facts.n * size)
    spread = 4 * max(facts.q / (facts.n * size) - mean * mean, 1.0) ** 0.5
    kind = next(k for k in ("int16", "int32", "int64") if largest <= np.iinfo(k).max)
    shape = _Shape(coding.parts, width, kind, max(facts.low, int(mean - spread)), min(facts.high, int(mean + spread) + 1))

    start = np.zeros((min(coding.entries, facts.n), coding.parts * width), dtype=np.int64)
    for i, r in enumerate(rows.orderBy(*order).limit(coding.entries).collect()):
        start[i, :size] = r.v
    books = np.stack(np.split(start, coding.parts, axis=1))

    points = rows.select("row", "v").mapInArrow(_points(shape), _POINTS)
    curve = ["part", "key", "row"]
    blocks = cut_lineage(points.repartitionByRange(*curve).sortWithinPartitions(*curve).select("part", "row", "point").mapInArrow(_packed(shape), _BLOCKS))
    for _ in range(coding.rounds):
        counts, sums = _round_sums(blocks, shape, books)
        used = counts > 0
        books = np.where(used[:, :, None], sums // np.maximum(counts, 1)[:, :, None], books)
    digits = F.transform(F.array_sort(F.collect_list(F.struct("part", "entry"))), lambda x: F.lpad(F.lower(F.hex(x["entry"])), 2, "0"))
    codes = _assigned(blocks, shape, books).groupBy("row").agg(F.array_join(digits, "").alias("code"), F.sum("error").alias("error"))
    found = cut_lineage(rows.select("row", "vec_id", "label").join(codes, "row").drop("row"))
    books = books.reshape(coding.parts, -1, width)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return with_total(found, "label", "error", "label_error").withColumn("codebooks_sha256", F.lit(digest))


def query(spark, sf_dir: str) -> DataFrame:
    found = coded(common.table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def _sql(coding: Coding) -> str:
    """The rounds as a chain of named steps."""
    steps = [f"""kept AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor({coding.scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
             "sized AS (SELECT *, len(v) // " + str(coding.parts) + " AS w FROM kept)",
             "pts AS (SELECT r, (i - 1) // w AS part, (i - 1) % w AS pos, v[i] AS x FROM (SELECT *, unnest(range(1, len(v) + 1)) AS i FROM sized))",
             f"cb0 AS (SELECT part, r - 1 AS entry, pos, x AS c FROM pts WHERE r <= {coding.entries})"]
    for k in range(coding.rounds + 1):
        steps.append(f"""a{k} AS MATERIALIZED (SELECT r, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM (
  SELECT p.r, p.part, c.entry, CAST(sum((p.x - c.c) * (p.x - c.c)) AS BIGINT) AS d FROM pts p JOIN cb{k} c ON p.part = c.part AND p.pos = c.pos GROUP BY p.r, p.part, c.entry) GROUP BY r, part)""")
        if k < coding.rounds:
            steps.append(f"""m{k} AS (SELECT p.part, a.entry, p.pos, CAST(sum(p.x) AS BIGINT) AS s, count(*) AS n FROM pts p JOIN a{k} a ON a.r = p.r AND a.part = p.part GROUP BY p.part, a.entry, p.pos)""")
            steps.append(f"""cb{k + 1} AS MATERIALIZED (SELECT c.part, c.entry, c.pos, CASE WHEN m.n IS NULL THEN c.c ELSE (m.s - ((m.s % m.n) + m.n) % m.n) // m.n END AS c
  FROM cb{k} c LEFT JOIN m{k} m ON m.part = c.part AND m.entry = c.entry AND m.pos = c.pos)""")
    last = coding.rounds
    steps.append(f"""codes AS (SELECT r, string_agg(lpad(lower(to_hex(entry)), 2, '0'), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{last} GROUP BY r)""")
    steps.append(f"""books AS (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, pos)) AS h FROM cb{last})""")
    return "WITH " + ",\n".join(steps) + """
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256 FROM kept JOIN codes USING (r), books"""


SQL = _sql(Coding())
