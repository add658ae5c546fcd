"""Removal of long passages that stand elsewhere too, by a compacted de Bruijn graph of the corpus.

A window of ``window`` words is an edge of the graph, from its first to its last words.  The graph is never spelled out: of the k-mers inside a
window the one with the smallest hash is its *anchor*, so neighbouring edges with one anchor form a nonbranching path, which is handled as a
whole and is called a block.  Equal windows have equal anchors, so a window can only be repeated where its anchor is.

1. One pass over the texts turns every text into its blocks: hash of the anchor, hash of the block's words, place in the text.
2. The blocks meet by anchor.  A block whose words stand elsewhere too is a repeated path: all its edges are.  A block that shares its anchor with
   other blocks only is at a branch and is looked into; of a repeated path that has such a neighbour one copy is looked into as well, as a witness.
3. The source coordinates (document and place) of these bring back their texts, whose single windows meet by 128 bits of hash.
4. The coordinates of repeated paths and windows, joined into spans, cut the words out of the texts.

A document that has no block at a branch is finished in step 3; only the others are carried on to step 4.  Hot passages: equal blocks (and windows)
of one chunk of texts are counted before they are shuffled, and an anchor with many different blocks in a chunk is dealt out by block.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import common
from tidewatch.session import cut_lineage

#: Words handled at once (a longer text is handled alone).
CHUNK = 1 << 20
#: Different blocks of an anchor in a chunk from which on they are dealt out by block.
HOT = 64
#: Rows handled at once where blocks or windows meet.
MEET = 1 << 19

# The multipliers of a well-known 64-bit finaliser, and two odd numbers as bases of rolling hashes.
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


@dataclass(frozen=True)
class Repeats:
    """Words of a window, and of the k-mers that are its anchors."""

    window: int = 35
    anchor: int = 12

    def __post_init__(self):
        if not 1 <= self.anchor <= self.window:
            raise ValueError("an anchor has at least one word and at most as many as a window")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class _Rolling:
    """Hashes of any stretch of a sequence of 64-bit word hashes, from prefix sums of powers modulo 2 ** 64."""

    def __init__(self, words: np.ndarray, base: int):
        n = len(words)
        powers = np.full(n + 1, np.uint64(base), dtype=np.uint64)
        powers[0] = 1
        self.down = np.full(n + 1, np.uint64(pow(base, -1, 1 << 64)), dtype=np.uint64)
        self.down[0] = 1
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_mixed(words + np.uint64(base)) * np.cumprod(powers)[:n], out=self.sums[1:])
        self.down = np.cumprod(self.down)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64) * _M1)


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the first smallest of every ``width`` neighbours."""
    def least(a, b):
        return np.where(values[a] <= values[b], a, b)
    at, have = np.arange(len(values)), 1
    while have * 2 <= width:
        at, have = least(at[:len(at) - have], at[have:]), have * 2
    return least(at[:len(at) - (width - have)], at[width - have:]) if have < width else at


def _blocks(words: np.ndarray, owner: np.ndarray, how: Repeats):
    """(first window, end after the last window, hash of the anchor, hash of the block) of all blocks, for the words of several texts in a row;
    ``owner`` numbers the text of each word."""
    if len(words) < how.window:
        none = np.empty(0, dtype=np.int64)
        return none, none, none.astype(np.uint64), none.astype(np.uint64)
    rolling = _Rolling(words, _BASES[0])
    starts = np.arange(len(words) - how.anchor + 1)
    mers = rolling(starts, starts + how.anchor)
    inside = owner[:len(words) - how.window + 1] == owner[how.window - 1:]
    anchor = np.where(inside, _smallest(mers, how.window - how.anchor + 1), -1)
    edge = np.flatnonzero(np.diff(anchor, prepend=-2, append=-2))
    first, end = edge[:-1], edge[1:]
    real = anchor[first] >= 0
    first, end = first[real], end[real]
    return first, end, mers[anchor[first]], rolling(first, end + how.window - 1)


# A piece of a text, from word ``at`` to before word ``to``, is the long at << 32 | to.
_ROWS = "route bigint, h bigint, b bigint, times int, hot boolean, id bigint, key bigint, piece bigint"
_MARKS = "id bigint, key bigint, piece bigint, kind int"
#: What became of a block: all its windows are repeated; it is at a branch; both, as the witness of a repeated path.
REPEATED, BRANCH, WITNESS = 0, 1, 2


def _batch(columns, schema: str) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    fields = [x.split() for x in schema.split(", ")]
    arrays = [c if isinstance(c, pa.Array) else pa.array(c.view(np.int64) if c.dtype == np.uint64 else c) for c in columns]
    arrays = [a.cast(kinds[kind]) for a, (_, kind) in zip(arrays, fields)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end row, words, owner of each word, start of each text) for stretches of rows of a batch whose third column is the word hashes."""
    column = batch.column(2)
    offsets = column.offsets.to_numpy().astype(np.int64)
    values = column.values.to_numpy(zero_copy_only=False).view(np.uint64)
    low = 0
    while low < len(batch):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + CHUNK, side="right")) - 1)
        at = offsets[low:high + 1]
        yield low, high, values[at[0]:at[-1]], np.repeat(np.arange(high - low), np.diff(at)), (at - at[0])[:-1]
        low = high


def _meeting_rows(h, b, ids, keys, at, to) -> list[pa.RecordBatch]:
    """The rows of a chunk by which its blocks or windows meet others.

    Of equal ones the first stands for all (``times``); the others are known to be repeated and pass through under a number of their own.
    """
    whole = _mixed(h ^ (b * _M1))
    _, first, group, times = np.unique(whole, return_index=True, return_inverse=True, return_counts=True)
    stands = np.zeros(len(h), dtype=bool)
    stands[first] = True
    count = np.where(stands, times[group], 0)
    own = _mixed(keys.astype(np.uint64) + at.astype(np.uint64) * _M2)
    names, name, kinds = np.unique(h[first], return_inverse=True, return_counts=True)
    crowded = np.zeros(len(h), dtype=bool)
    crowded[first] = kinds[name] >= HOT
    route = np.where(stands, np.where(crowded, whole, h), own)
    rows = _batch([route, np.where(stands, h, own), np.where(stands, b, np.uint64(0)), count, crowded, ids, keys, (at << 32) | to], _ROWS)
    full = names[kinds >= HOT]
    if not len(full):
        return [rows]
    # The rest of the anchor's blocks, wherever they are, must hear of those that were dealt out.
    none, zero = pa.nulls(len(full), pa.int64()), np.zeros(len(full), dtype=np.int64)
    return [rows, _batch([full, full, _mixed(full), zero + 1, zero.astype(bool), none, none, zero], _ROWS)]


def _met(rows: DataFrame) -> DataFrame:
    """(id, key, piece, kind) of the rows that are not alone: REPEATED with equal h and b, BRANCH with other b only, WITNESS for the first of equal
    ones that also have neighbours with other b.  Streams over the sorted rows; only rows with equal h and b are held."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, before = None, None  # the last group, which may go on; the h of the last group that was handed on
        waiting: list[pa.RecordBatch] = []
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                waiting.append(batch)
                if sum(map(len, waiting)) < MEET:
                    continue
            parts = ([held] if held is not None else []) + [t for t in waiting if len(t)]
            waiting = []
            if not parts:
                continue
            table = pa.Table.from_batches(parts).combine_chunks()
            h, b = (table.column(c).to_numpy() for c in ("h", "b"))
            new = np.r_[True, (h[1:] != h[:-1]) | (b[1:] != b[:-1])]
            cut = len(table) if batch is None else int(np.flatnonzero(new)[-1])
            held = None if batch is None else table.slice(cut).combine_chunks().to_batches()[0]
            if cut == 0:
                continue
            next_h = None if cut == len(table) else h[cut]
            table, h, new = table.slice(0, cut), h[:cut], new[:cut]
            first = np.flatnonzero(new)
            group = np.cumsum(new) - 1
            times = table.column("times").to_numpy()
            total = np.add.reduceat(times, first)
            of = h[first]
            same = of[1:] == of[:-1]
            several = np.r_[same, of[-1] == next_h] | np.r_[of[0] == before, same]
            several |= np.logical_or.reduceat(table.column("hot").to_numpy(), first)
            before = of[-1]
            repeated = (total >= 2)[group] | (times == 0)
            kind = np.where(repeated, REPEATED, np.where(several[group], BRANCH, -1))
            kind[first[(total >= 2) & several]] = WITNESS
            keep = (kind >= 0) & table.column("id").is_valid().to_numpy()
            some = table.select(["id", "key", "piece"]).filter(pa.array(keep)).combine_chunks()
            for out in some.append_column("kind", pa.array(kind[keep].astype(np.int32))).to_batches():
                yield out
    return rows.repartition("route").sortWithinPartitions("h", "b").mapInArrow(run, _MARKS)


def _named(docs: DataFrame) -> DataFrame:
    """(doc_id, id, key, text): id and key name a row by its doc_id and text; equal rows have the same name."""
    rows = docs.select(F.col("doc_id"), common.whole(F.col("text")).alias("text"))
    return rows.select("doc_id", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63))).alias("id"),
                       F.xxhash64("doc_id", "text").alias("key"), "text")


def _hashed(text: Column) -> Column:
    return F.transform(common.words(text), lambda w: F.xxhash64(w))


def block_marks(docs: DataFrame, how: Repeats = Repeats()) -> DataFrame:
    """(id, key, piece, kind) of the blocks of all texts that share their anchor: the piece of the text, and REPEATED, BRANCH or WITNESS."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = (batch.column(i).to_numpy() for i in range(2))
            for low, _, words, owner, start in _chunks(batch):
                first, end, h, b = _blocks(words, owner, how)
                if len(first):
                    text = owner[first]
                    yield from _meeting_rows(h, b, ids[low + text], keys[low + text], first - start[text], end - start[text] + how.window - 1)
    texts = _named(docs).select("id", "key", _hashed(F.col("text")).alias("words"))
    return _met(texts.mapInArrow(run, _ROWS))


def window_marks(texts: DataFrame, how: Repeats = Repeats()) -> DataFrame:
    """(id, key, piece) of the repeated windows of the blocks at branches; ``texts`` has id, key, text and the pieces ``branches`` and
    ``witnesses``, whose windows only bear witness."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, fresh = (batch.column(i).to_numpy() for i in (0, 1, 4))
            offsets = batch.column(3).offsets.to_numpy()
            pieces = batch.column(3).values.to_numpy()
            for low, high, words, _, start in _chunks(batch):
                some, many = pieces[offsets[low]:offsets[high]], np.diff(offsets[low:high + 1])
                text = np.repeat(np.arange(high - low), many)
                shown = np.arange(len(some)) - np.repeat(np.cumsum(many) - many, many) >= fresh[low + text]
                at, to = some >> 32, some & 0xFFFFFFFF
                windows = to - at - how.window + 1
                text, shown, began = (np.repeat(x, windows) for x in (text, shown, at))
                began = began + np.arange(len(began)) - np.repeat(np.cumsum(windows) - windows, windows)
                place = start[text] + began
                h, b = (_Rolling(words, base)(place, place + how.window) for base in _BASES)
                if len(h):
                    yield from _meeting_rows(h, b, pa.array(ids[low + text], mask=shown), keys[low + text], began, began + how.window)
    rows = texts.select("id", "key", _hashed(F.col("text")).alias("words"), F.concat("branches", "witnesses").alias("pieces"), F.size("branches").alias("n"))
    return _met(rows.mapInArrow(run, _ROWS)).filter(F.col("kind") != BRANCH).drop("kind")


def _at(piece: Column) -> Column:
    return F.shiftright(piece, 32).cast("int")


def _to(piece: Column) -> Column:
    return piece.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")


def _spans(pieces: Column) -> Column:
    """Spans of the pieces, joined where they touch.  The first words of the windows of two pieces never mix, so pieces end in the order they begin."""
    def joined(s: Column) -> Column:
        starts = F.filter(s, lambda x, i: (i == 0) | (_at(x) > _to(F.get(s, i - 1))))
        ends = F.filter(s, lambda x, i: (i == F.size(s) - 1) | (_at(F.get(s, i + 1)) > _to(x)))
        return F.zip_with(starts, ends, lambda a, b: F.struct(_at(a).alias("at"), _to(b).alias("to")))
    return common.bind(F.array_sort(pieces), joined)


def _kept(words: Column, spans: Column) -> Column:
    """The words outside the spans."""
    def stretch(i: Column) -> Column:
        low = F.when(i == 0, 0).otherwise(F.get(spans, i - 1)["to"])
        high = F.when(i == F.size(spans), F.size(words)).otherwise(F.get(spans, i)["at"])
        return F.slice(words, low + 1, high - low)
    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(spans)), stretch))


def as_text(words: Column) -> Column:
    return F.array_join(words, " ")


def without_repeats(docs: DataFrame, how: Repeats = Repeats(), result: Callable[[Column], Column] = as_text, name: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, spans, and ``name``) of every row of ``docs`` (doc_id, text; further columns are ignored).

    A word goes if a window of ``how.window`` words that covers it also begins anywhere else, in the same text or another; windows are judged on
    the input.  ``spans`` are the removed stretches (at, to), in words, sorted and apart; ``result`` turns the kept words into the last column, by
    default into a text with single blanks.  Words are runs of anything but ASCII white space, unchanged.  Null and empty texts have no
    words; texts shorter than a window lose nothing.  Rows with a null or repeated doc_id take part like others, and repeated rows are repeats of
    each other.  An empty table gives no rows.  Words are compared by 64-bit hashes, blocks by the hashes of anchor and words, windows
    by 128 bits.  A single text has to fit in a task.
    """
    none = F.array().cast("array<bigint>")
    marks = block_marks(docs, how).groupBy("id", "key").agg(
        F.collect_set(F.when(F.col("kind") != BRANCH, F.col("piece"))).alias("known"), F.collect_set(F.when(F.col("kind") != REPEATED, F.col("piece"))).alias("looked"))
    found = _named(docs).join(marks, ["id", "key"], "left").withColumns(
        {"known": F.coalesce("known", none), "looked": F.coalesce("looked", none), "words": common.words(F.col("text"))})
    carried = {"text": F.col("text"), "known": F.col("known"), "branches": F.array_except("looked", "known"),
               "witnesses": F.array_intersect("looked", "known")}
    first = cut_lineage(found.withColumn("spans", _spans(F.col("known"))).withColumn("done", F.size("looked") == 0).select(
        "doc_id", "id", "key", "done", F.size("words").cast("bigint").alias("n_words"), F.when(F.col("done"), F.col("spans")).alias("spans"),
        F.when(F.col("done"), result(_kept(F.col("words"), F.col("spans")))).alias(name),
        *[F.when(~F.col("done"), c).alias("raw_" + n) for n, c in carried.items()]))
    rest = first.filter("not done").select("doc_id", "id", "key", "n_words", *[F.col("raw_" + n).alias(n) for n in carried])
    more = window_marks(rest, how).groupBy("id", "key").agg(F.collect_set("piece").alias("more"))
    rest = rest.join(more, ["id", "key"], "left").withColumns(
        {"spans": _spans(F.array_union("known", F.coalesce("more", none))), "words": common.words(F.col("text"))})
    out = ["doc_id", "n_words", "spans"]
    rows = first.filter("done").select(*out, name).unionByName(rest.select(*out, result(_kept(F.col("words"), F.col("spans"))).alias(name)))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["to"] - s["at"])
    return rows.select("doc_id", "n_words", removed.alias("n_removed"), "spans", name)


def query(spark, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    found = without_repeats(docs, result=lambda words: F.sha2(F.encode(as_text(words), "UTF-8"), 256), name="kept_sha256")
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


SQL = r"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id,
                      list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents),
places AS (SELECT r, words, unnest(range(1, len(words) + 1)) AS i FROM texts),
windows AS (SELECT r, i, words[i] AS word, CASE WHEN i + 34 <= len(words) THEN hash(words[i:i + 34]) END AS win FROM places),
counted AS (SELECT *, win IS NOT NULL AND count(*) OVER (PARTITION BY win) > 1 AS again FROM windows),
covered AS (SELECT *, bool_or(again) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone FROM counted),
summed AS (SELECT r, count(*) FILTER (gone) AS n, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM covered GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN summed USING (r)
"""
