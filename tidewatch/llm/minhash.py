"""Near-duplicates by HyperMinHash, confirmed on full shingle sets.

1. One pass over the texts sketches every shingle set: the hash of a shingle picks a bucket, and each bucket keeps its smallest
   hash compressed to a leading-zero count and mantissa bits in 16 bits.  Buckets that stay empty borrow from others.
2. Documents with equal sets (128-bit fingerprint and size) form a class; from here on only classes are handled, so copies cost nothing.
3. Bands of registers send classes to band buckets.  Each member of a bucket is first compared with the bucket's smallest
   member, by the collision-corrected Jaccard estimate; a bar far below the wanted similarity keeps the two in one cluster.
4. Clusters are the connected components of these pairs.  Where the members of a bucket are then still of several clusters, all its pairs
   across clusters are compared in blocks, and the clusters that these link are joined: members of a bucket are of one cluster or were compared.
5. Inside a cluster all pairs are checked exactly, in blocks of BLOCK x BLOCK sets: intersection sizes come from one matrix product
   per block, and a block returns a spanning forest of its links, never the pairs themselves.
6. Components of the links give the groups.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewatch.llm import common
from tidewatch.llm.components import components
from tidewatch.session import cut_lineage

#: Probability that a pair at the threshold shares no band.
MISS = 1e-6
#: A register: 6 bits of leading zeros, 10 bits of mantissa.
MANTISSA = 10
#: Estimate below which two members of a bucket are not joined to one cluster.
CLUSTER_BAR = 0.5
#: Classes per side of a block.
BLOCK = 256

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    x = x + _GOLDEN
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


@dataclass(frozen=True)
class Likeness:
    """Words per shingle and the wanted Jaccard similarity in percent; registers and bands follow."""

    words: int = 5
    percent: int = 80

    @property
    def rows(self) -> int:
        return 6 if self.percent >= 85 else 5

    @property
    def bands(self) -> int:
        return math.ceil(math.log(MISS) / math.log(1 - (self.percent / 100) ** self.rows))

    @property
    def registers(self) -> int:
        return self.rows * self.bands


def shingle_hashes(hashes: np.ndarray, words: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text, given those of its words; fewer words make one shingle."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(words, n)
    rolled = mixed(hashes[: n - width + 1])
    for i in range(1, width):
        rolled = mixed(rolled ^ hashes[i: n - width + 1 + i])
    return np.unique(rolled if n >= words else mixed(rolled ^ np.uint64(n)))


def registers_of(shingles: np.ndarray, m: int) -> np.ndarray:
    """m 16-bit registers of a set that is not empty.

    The bucket takes one hash, the value another.  The minimum of a bucket is kept as (leading zeros, the MANTISSA bits after the first one).
    An empty bucket takes over the register of the first filled bucket in a sequence that depends on its number only.
    """
    bucket = (mixed(shingles) % np.uint64(m)).astype(np.int64)
    value = mixed(shingles ^ _M1)
    least = np.full(m, np.iinfo(np.uint64).max, dtype=np.uint64)
    np.minimum.at(least, bucket, value)
    filled = np.zeros(m, dtype=bool)
    filled[bucket] = True
    value = np.maximum(least, np.uint64(1))
    top = np.floor(np.log2(value.astype(np.float64))).astype(np.int64)
    top = np.where((np.uint64(1) << np.minimum(top, 63).astype(np.uint64)) > value, top - 1, np.minimum(top, 63))
    zeros = 63 - top
    rest = value ^ (np.uint64(1) << top.astype(np.uint64))
    shift = top - MANTISSA
    mantissa = np.where(shift >= 0, rest >> np.maximum(shift, 0).astype(np.uint64), rest << np.maximum(-shift, 0).astype(np.uint64))
    out = ((zeros.astype(np.uint64) << np.uint64(MANTISSA)) | mantissa).astype(np.uint16)
    empty = np.flatnonzero(~filled)
    step = 1
    while len(empty):
        source = mixed(empty.astype(np.uint64) | np.uint64(step << 32))
        pick = (source % np.uint64(m)).astype(np.int64)
        good = filled[pick]
        out[empty[good]] = out[pick[good]]
        empty, step = empty[~good], step + 1
    return out


#: Probability that two different minima leave equal registers.
COLLISION = sum(0.25 ** (z + 1) * 2.0 ** -MANTISSA for z in range(40))


def estimated(equal: np.ndarray, m: int) -> np.ndarray:
    """Jaccard similarity from the number of equal registers, corrected for registers that collide by chance."""
    return np.clip((equal / m - COLLISION) / (1 - COLLISION), 0, 1)


class _WordHashes(dict):
    """Hashes of words, lower-cased in A-Z; forgets all when it grows too large."""

    def __missing__(self, word: bytes) -> int:
        import xxhash
        if len(self) > 400_000:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word.translate(_LOWER))
        return found


_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _word_hashes(text: str | None, cache: _WordHashes) -> np.ndarray:
    parts = (text or "").encode("utf-8", "surrogatepass").split()  # bytes split at ASCII white space only
    return np.fromiter(map(cache.__getitem__, parts), dtype=np.uint64, count=len(parts))


_SKETCH = "doc_id bigint, text_key string, n_shingles bigint, f1 bigint, f2 bigint, registers binary"


def text_key(text: Column) -> Column:
    """Names a text, so that repeated ids can be told apart."""
    return F.md5(common.whole(text))


def sketched(docs: DataFrame, like: Likeness) -> DataFrame:
    """(doc_id, text_key, n_shingles, f1, f2, registers) of every row of (doc_id, text); null registers without words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _WordHashes()
        for batch in batches:
            out = []
            for text in batch.column(2):
                s = shingle_hashes(_word_hashes(text.as_py(), cache), like.words)
                if len(s):
                    out.append((len(s), int(np.bitwise_xor.reduce(mixed(s ^ _M2)).astype(np.int64)), int(np.add.reduce(mixed(s)).astype(np.int64)),
                                registers_of(s, like.registers).tobytes()))
                else:
                    out.append((0, 0, 0, None))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            cols = [pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *cols],
                                             names=["doc_id", "text_key", "n_shingles", "f1", "f2", "registers"])
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_key(F.col("text")).alias("text_key"),
                       F.col("text").cast("string").alias("text")).mapInArrow(run, _SKETCH)


def classes_of(sketches: DataFrame) -> DataFrame:
    """(class, n_shingles, f1, f2, least_id, registers): one row per distinct non-empty set, numbered once and for all by being written."""
    groups = sketches.filter("n_shingles > 0").groupBy("n_shingles", "f1", "f2").agg(
        F.min("doc_id").alias("least_id"), F.first("registers").alias("registers"))
    return cut_lineage(groups.withColumn("class", F.monotonically_increasing_id()))


def band_pairs(classes: DataFrame, like: Likeness) -> tuple[DataFrame, DataFrame]:
    """(a, b): every member b of a band bucket with its smallest member a, once each; and (band, hash, a, class): the members of the buckets of
    more than two."""
    width = like.rows * 2
    bands = F.array(*[F.xxhash64(F.lit(i), F.substring("registers", i * width + 1, width)) for i in range(like.bands)])
    rows = classes.select("class", F.posexplode(bands).alias("band", "hash"))
    ends = rows.groupBy("band", "hash").agg(F.min("class").alias("a"), F.max("class").alias("z"), F.count("*").alias("n")).filter("a < z")
    ends = cut_lineage(ends)
    small = ends.filter("n = 2").select("a", F.col("z").alias("b"))
    crowds = cut_lineage(rows.join(ends.filter("n > 2"), ["band", "hash"]).select("band", "hash", "a", "class"))
    large = crowds.filter("class <> a").select("a", F.col("class").alias("b"))
    return small.unionByName(large).distinct(), crowds


def close_pairs(pairs: DataFrame, classes: DataFrame, like: Likeness, bar: float) -> DataFrame:
    """Pairs (u, v) whose estimated similarity reaches the bar."""
    sketch = classes.select("class", "registers")
    joined = (pairs.join(sketch.select(F.col("class").alias("b"), F.col("registers").alias("right")), "b")
              .join(sketch.select(F.col("class").alias("a"), F.col("registers").alias("left")), "a"))
    m = like.registers

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if len(rows):
                left = np.frombuffer(b"".join(rows["left"]), dtype=np.uint16).reshape(-1, m)
                right = np.frombuffer(b"".join(rows["right"]), dtype=np.uint16).reshape(-1, m)
                near = estimated((left == right).sum(axis=1), m) >= bar
                yield rows.loc[near, ["a", "b"]].rename(columns={"a": "u", "b": "v"})
    return joined.select("a", "b", "left", "right").mapInPandas(run, "u bigint, v bigint")


def strange_pairs(crowds: DataFrame, clusters: DataFrame, classes: DataFrame, like: Likeness, bar: float) -> DataFrame:
    """(u, v): spanning links of the pairs of a bucket whose classes are of different clusters and whose estimated similarity reaches the bar.

    ``crowds`` has the members of the buckets, ``clusters`` (node, component) of the classes that have one.  The members of a bucket are ranked
    by cluster, blocks are BLOCK neighbours, and two blocks meet unless both hold one and the same cluster; a task holds two blocks.
    """
    bucket = ["band", "hash"]
    named = crowds.select(*bucket, "class").join(clusters, F.col("class") == F.col("node"), "left")
    named = cut_lineage(named.select(*bucket, "class", F.coalesce("component", "class").alias("cluster")))
    mixed_ones = named.groupBy(*bucket).agg(F.min("cluster").alias("low"), F.max("cluster").alias("high")).filter("low < high").select(*bucket)
    rows = common.ranged(named.join(mixed_ones, bucket), [*bucket, "cluster", "class"])
    rows, _ = common.summed_before(rows.withColumn("one", F.lit(1)), "one", "place")
    rows = cut_lineage(rows.select(*bucket, "cluster", "class", "place"))
    first = rows.groupBy(*bucket).agg(F.min("place").alias("first"))
    rows = rows.join(first, bucket).select(*bucket, "cluster", "class", F.expr(f"(place - first) div {BLOCK}").alias("block"))
    blocks = cut_lineage(rows.groupBy(*bucket, "block").agg(F.min("cluster").alias("low"), F.max("cluster").alias("high")))
    one = blocks.select(*bucket, F.col("block").alias("i"), F.col("low").alias("i_low"))
    two = blocks.select(*bucket, F.col("block").alias("j"), F.col("high").alias("j_high"))
    meets = cut_lineage(one.join(two, bucket).filter("i <= j and i_low < j_high").select(*bucket, "i", "j"))
    sides = meets.select(*bucket, "i", "j", F.col("i").alias("block"), F.lit(0).alias("side")).unionByName(
        meets.filter("i < j").select(*bucket, "i", "j", F.col("j").alias("block"), F.lit(1).alias("side")))
    task = [*bucket, "i", "j"]
    dealt = rows.join(sides, [*bucket, "block"]).select(*task, "side", "cluster", "class").join(classes.select("class", "registers"), "class")
    m = like.registers

    def links(rows: pd.DataFrame) -> list[tuple[int, int]]:
        table = np.frombuffer(b"".join(rows["registers"]), dtype=np.uint16).reshape(-1, m)
        cluster, name, side = (rows[c].to_numpy() for c in ("cluster", "class", "side"))
        left = np.flatnonzero(side == 0)
        right = left if side.max() == 0 else np.flatnonzero(side == 1)
        near_a, near_b = [], []
        for x in left:
            others = right[cluster[right] > cluster[x]]  # blocks are ranked by cluster
            others = others[estimated((table[others] == table[x]).sum(axis=1), m) >= bar]
            near_a.append(np.full(len(others), name[x]))
            near_b.append(name[others])
        return _forest(np.concatenate(near_a), np.concatenate(near_b))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for rows in itertools.chain(batches, [None]):
            last = rows is None
            rows = held if last else rows if held is None else pd.concat([held, rows], ignore_index=True)
            if rows is None or not len(rows):
                continue
            keys = rows[task].to_numpy()
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), *([len(rows)] if last else [])]
            out = [link for low, high in itertools.pairwise(cuts) for link in links(rows.iloc[low:high])]
            held = rows.iloc[cuts[-1]:]  # its task may go on in the next batch
            yield pd.DataFrame(out, columns=["u", "v"], dtype="int64")
    dealt = dealt.repartition(*[F.col(c) for c in task]).sortWithinPartitions(*task)
    return dealt.select(*task, "side", "cluster", "class", "registers").mapInPandas(run, "u bigint, v bigint").distinct()


def shingle_sets(docs: DataFrame, wanted: DataFrame, like: Likeness) -> DataFrame:
    """(class, set): the sorted 64-bit shingle hashes of one document of each wanted (class, doc_id, n_shingles, f1, f2).

    The wanted documents are a share of the corpus, so they are merged and never broadcast, whatever the size.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).join(
        wanted.withColumnRenamed("least_id", "doc_id").hint("merge"), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _WordHashes()
        for batch in batches:
            names, sets = [], []
            for name, n, f1, text in zip(*(batch.column(c).to_pylist() for c in ("class", "n_shingles", "f1")), batch.column("text")):
                s = shingle_hashes(_word_hashes(text.as_py(), cache), like.words)
                if len(s) == n and int(np.bitwise_xor.reduce(mixed(s ^ _M2)).astype(np.int64)) == f1:
                    names.append(name)
                    sets.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(sets, pa.binary())], names=["class", "set"])
    found = texts.select("class", "n_shingles", "f1", "text").mapInArrow(run, "class bigint, set binary")
    return found.groupBy("class").agg(F.first("set").alias("set"))  # an id may stand on several rows


def _intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections: products of 0/1 rows over the shingles on both sides, a slice of them at a time."""
    every_left, every_right = np.concatenate(left), np.concatenate(right)
    common_ones = np.intersect1d(every_left, every_right)
    out = np.zeros((len(left), len(right)), dtype=np.float32)

    def places(sets: list[np.ndarray], flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        at = np.searchsorted(common_ones, flat)
        hit = (at < len(common_ones)) & (common_ones[np.minimum(at, len(common_ones) - 1)] == flat)
        order = np.argsort(at[hit], kind="stable")
        return owner[hit][order], at[hit][order]
    if len(common_ones):
        (l_own, l_at), (r_own, r_at) = places(left, every_left), places(right, every_right)
        step = 1 << 14
        for low in range(0, len(common_ones), step):
            def dense(own, at, n):
                a, b = np.searchsorted(at, [low, low + step])
                table = np.zeros((n, step), dtype=np.float32)
                table[own[a:b], at[a:b] - low] = 1
                return table
            out += dense(l_own, l_at, len(left)) @ dense(r_own, r_at, len(right)).T
    return np.rint(out).astype(np.int64)


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Links that keep the pairs' components."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x
    out = []
    for x, y in zip(a.tolist(), b.tolist()):
        rx, ry = find(x), find(y)
        if rx != ry:
            root[rx] = ry
            out.append((x, y))
    return out


def confirmed_links(sets: DataFrame, like: Likeness) -> DataFrame:
    """(u, v): spanning links of the pairs within each cluster of (cluster, class, n, rank, set) that are as similar as wanted.

    Classes of a cluster are ranked by size, blocks are BLOCK neighbours, and two blocks meet only where their sizes allow the
    similarity.  Every class goes to as many tasks as its block has partners; a task holds two blocks.
    """
    rows = sets.withColumn("block", F.expr(f"rank div {BLOCK}")).drop("rank")
    blocks = cut_lineage(rows.groupBy("cluster", "block").agg(F.min("n").alias("low"), F.max("n").alias("high")))
    one = blocks.select("cluster", F.col("block").alias("i"), F.col("high").alias("i_high"))
    two = blocks.select("cluster", F.col("block").alias("j"), F.col("low").alias("j_low"))
    meets = one.join(two, "cluster").filter((F.col("i") <= F.col("j")) & (F.col("i_high") * 100 >= F.col("j_low") * like.percent))
    meets = cut_lineage(meets.select("cluster", "i", "j"))
    sides = meets.select("cluster", "i", "j", F.col("i").alias("block"), F.lit(0).alias("side")).unionByName(
        meets.filter("i < j").select("cluster", "i", "j", F.col("j").alias("block"), F.lit(1).alias("side")))
    dealt = rows.join(sides, ["cluster", "block"]).select("cluster", "i", "j", "side", "class", "n", "set")

    def check(rows: pd.DataFrame) -> pd.DataFrame:
        first, second = rows[rows["side"] == 0], rows[rows["side"] == 1]
        own = second.empty
        second = first if own else second
        left, right = ([np.frombuffer(x, dtype=np.uint64) for x in part["set"]] for part in (first, second))
        shared = _intersections(left, right)
        union = first["n"].to_numpy()[:, None] + second["n"].to_numpy()[None, :] - shared
        near = shared * 100 >= union * like.percent
        if own:
            near = np.triu(near, 1)
        a, b = np.nonzero(near)
        links = _forest(first["class"].to_numpy()[a], second["class"].to_numpy()[b])
        return pd.DataFrame(links, columns=["u", "v"], dtype="int64")
    return dealt.groupBy("cluster", "i", "j").applyInPandas(check, "u bigint, v bigint")


def grouped(docs: DataFrame, like: Likeness) -> DataFrame:
    """(doc_id, text_key, n_shingles, group, component_id) of every row: ``group`` numbers a group of linked rows and is null without words,
    ``component_id`` is its smallest doc_id."""
    sketches = cut_lineage(sketched(docs, like))
    classes = classes_of(sketches)
    pairs, crowds = band_pairs(classes, like)
    clusters = cut_lineage(components(close_pairs(pairs, classes, like, CLUSTER_BAR)))
    more = cut_lineage(strange_pairs(crowds, clusters, classes, like, CLUSTER_BAR))
    if not more.isEmpty():
        clusters = cut_lineage(components(clusters.select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(more)))
    members = cut_lineage(clusters.join(classes.drop("registers"), clusters.node == F.col("class"))
                          .select(F.col("component").alias("cluster"), "class", F.col("n_shingles"), "f1", "f2", "least_id"))
    ranked = common.ranged(members.select("cluster", "class", F.col("n_shingles").alias("n")), ["cluster", "n", "class"])
    ranked, _ = common.summed_before(ranked.withColumn("one", F.lit(1)), "one", "place")
    ranked = cut_lineage(ranked.select("cluster", "class", "n", "place"))
    first = ranked.groupBy("cluster").agg(F.min("place").alias("first"))
    ranked = ranked.join(first, "cluster").select("cluster", "class", "n", (F.col("place") - F.col("first")).alias("rank"))
    sets = cut_lineage(ranked.join(shingle_sets(docs, members.drop("cluster"), like), "class"))
    linked = components(confirmed_links(sets, like))
    key = ["n_shingles", "f1", "f2"]
    every = classes.select(*key, "class", "least_id").join(linked, F.col("class") == F.col("node"), "left")
    every = every.select(*key, "least_id", F.coalesce("component", "class").alias("group"))
    names = every.groupBy("group").agg(F.min("least_id").alias("component_id"))
    named = cut_lineage(every.join(names, "group").select(*key, "group", "component_id"))  # read plainly, so that a hot class can be split
    worded = sketches.filter("n_shingles > 0").join(named, key).select("doc_id", "text_key", "n_shingles", "group", "component_id")
    return worded.unionByName(sketches.filter("n_shingles = 0").select(
        "doc_id", "text_key", "n_shingles", F.lit(None).cast("bigint").alias("group"), F.col("doc_id").alias("component_id")))


def near_duplicates(docs: DataFrame, like: Likeness = Likeness()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text; further columns are ignored).

    ``component_id`` is the smallest doc_id reachable over links, ``kept`` is true for that document.  Words are runs of anything but ASCII
    white space, lower-cased in A-Z; a text with fewer words than a shingle is one shingle; null texts and texts without words have
    no shingle, link with nothing and are kept.  Rows with a null doc_id take part, are not kept unless all ids of their group are null, and
    give no name while another does; repeated rows are judged alike, so a repeated smallest id is kept on each of its rows.  An
    empty table gives no rows.  Shingles are compared by 64-bit hashes, sets of equal size and 128-bit fingerprint count as equal.
    """
    found = grouped(docs, like).select("doc_id", "n_shingles", "component_id")
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicated(docs: DataFrame, like: Likeness = Likeness()) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of every group the row with the smallest doc_id (null last), then text key; a repeated row once.
    Rows without words all stay."""
    groups = cut_lineage(grouped(docs, like))
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")
    best = groups.filter("group is not null").groupBy("group").agg(F.min(order).alias("b")).select("b.doc_id", "b.text_key")
    blank = groups.filter("group is null").select("doc_id", "text_key").distinct().withColumn("__all", F.lit(True))
    stay = best.withColumn("__all", F.lit(False)).unionByName(blank).select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("__id"), F.col("text_key").alias("__key"), "__all")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("__id"), text_key(F.col("text")).alias("__key"))
    nth = F.row_number().over(Window.partitionBy("__key", "__id").orderBy("__all"))
    return rows.join(stay, ["__key", "__id"]).withColumn("__nth", nth).filter("__all or __nth = 1").select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(common.table(spark, sf_dir, "documents").select("doc_id", "text"), Likeness(words=3, percent=85))
