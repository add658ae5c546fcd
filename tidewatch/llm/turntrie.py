"""Prefix trie of conversations: what every shared opening is worth, from double-array tries over ranges of the corpus.

A conversation is the path of its turns; a node is a distinct opening, named by its depth and the running XOR of 2 x 64 hash bits of (place, role,
text).  Paths are cut into stretches of ``STRETCH`` turns, so that no path, however long, has to fit in one task.

1. Turns are numbered in their conversation over range-sorted rows; only hashes and lengths of texts go on from there.
2. Equal stretches that continue equal openings become one row with counts.  Range-sorted, these rows are the shards.
3. A task packs its shard, SHARD stretches at a time, into a double-array trie (BASE, CHECK) over dense turn ids and walks it: every node gets
   its conversations, children, leaves and sums over its subtree.  All of them add up over shards, as each counts the nodes that it holds.
4. The upper nodes that neighbouring shards share lie on the last path of one and the first path of the other.  They were counted twice, which
   these two paths alone can tell, so they are counted off.
5. What hangs below the end of a stretch is handed to one conversation that goes on there, and along it to the stretches above.
6. The nodes' parts are added up over all shards by name.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewatch.llm import common
from tidewatch.session import cut_lineage

#: Turns of a stretch.
STRETCH = 64
#: Stretches of a double-array trie.
SHARD = 4096
#: Ids of a node that are joined at once for its digest.
IDS = 512

#: Stands for a null conv_id; sorts last.
_NO_ID = (1 << 63) - 1


# ---- the trie of a shard ----

class DoubleArray:
    """A trie over sequences of dense ids: child ``c`` of state ``s`` is ``base[s] + c`` where ``check`` of that is ``s``.

    ``sequences`` is a matrix of ids, a row per sequence in sorted order, with -1 behind its end.  State 0 is the root.
    """

    def __init__(self, sequences: np.ndarray):
        self.base, self.check = np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)
        self.used = 1  # all states from here on are free
        state = np.zeros(len(sequences), dtype=np.int64)
        for code in sequences.T:
            rows = np.flatnonzero(code >= 0)
            family = np.unique(np.stack([state[rows], code[rows]], 1), axis=0)
            self._place(family[:, 0], family[:, 1])
            state[rows] = self.base[state[rows]] + code[rows]

    def _reserve(self, size: int) -> None:
        more = max(size - len(self.base), 0)
        if more:
            more += len(self.base)
            self.base = np.concatenate([self.base, np.zeros(more, dtype=np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, dtype=np.int64)])

    def _place(self, parent: np.ndarray, code: np.ndarray) -> None:
        first = np.flatnonzero(np.diff(parent, prepend=-1))
        many = np.diff(np.append(first, len(parent)))
        for at, n in zip(first[many > 1], many[many > 1]):
            codes = code[at:at + n]
            self.base[parent[at]] = base = self._gap(codes)
            self.check[base + codes] = parent[at]
            self.used = max(self.used, int(base + codes[-1]) + 1)
        lone = first[many == 1]  # fits wherever one state is free
        self._reserve(self.used + len(lone))
        free = np.flatnonzero(self.check[:self.used + len(lone)] < 0)[:len(lone)]
        self.base[parent[lone]] = free - code[lone]
        self.check[free] = parent[lone]
        self.used = max(self.used, int(free.max(initial=0)) + 1)

    def _gap(self, codes: np.ndarray) -> int:
        """The base of a family: the first gap of a few that takes all of it, or the end."""
        self._reserve(self.used + int(codes[-1] - codes[0]) + 1)
        for slot in np.flatnonzero(self.check[:self.used] < 0)[:32]:
            base = int(slot - codes[0])
            if base + codes[-1] < len(self.check) and (self.check[base + codes] < 0).all():
                return base
        return int(self.used - codes[0])

    def step(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The children of states; -1 where there is none."""
        to = self.base[state] + code
        inside = (to > 0) & (to < len(self.check))
        return np.where(inside & (self.check[np.where(inside, to, 0)] == state), to, -1)


#: What a shard says.  NODE rows: a node by name, its parent, the code points of its last text, and what adds up over shards.  HANDED rows: ``owned``
#: and ``leaves`` for all nodes on the path of conversation ``least`` above level ``depth``.  EDGE rows: the first and last stretch of a task.
NODE, HANDED, EDGE = 0, 1, 2
_SUMS = ["convs", "weight", "owned", "children", "leaves"]
_LONGS = ["n1", "n2", "m1", "m2", "chars", "least", *_SUMS]
_PATH = "array<struct<x1:bigint,x2:bigint,chars:bigint,y1:bigint,y2:bigint>>"
_SAID = f"kind int, depth int, {', '.join(c + ' bigint' for c in _LONGS)}, part int, ending boolean, goes_on boolean, path {_PATH}"


def _said(kind: int, n: int, **columns) -> pa.RecordBatch:
    """``n`` rows of _SAID; sums that are not given are 0, others null."""
    def array(name: str, kind_of: pa.DataType) -> pa.Array:
        given = columns.get(name, 0 if name in _SUMS else None)
        if given is None or np.ndim(given) == 0 and not isinstance(given, pa.Array):
            return pa.array([given] * n, kind_of)
        return given if isinstance(given, pa.Array) else pa.array(given, kind_of)
    path = pa.list_(pa.struct([(c, pa.int64()) for c in ("x1", "x2", "chars", "y1", "y2")]))
    kinds = {"kind": pa.int32(), "depth": pa.int32(), **dict.fromkeys(_LONGS, pa.int64()), "part": pa.int32(), "ending": pa.bool_(),
             "goes_on": pa.bool_(), "path": path}
    columns["kind"] = kind
    return pa.RecordBatch.from_arrays([array(c, k) for c, k in kinds.items()], names=list(kinds))


def _paths(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(stretch of each turn, its five numbers as columns)."""
    path = table.column("path").combine_chunks()
    path = path.chunk(0) if isinstance(path, pa.ChunkedArray) else path
    row = np.repeat(np.arange(len(path)), np.diff(path.offsets.to_numpy()))
    turns = path.flatten()
    return row, np.stack([turns.field(i).to_numpy() for i in range(5)], 1)


def _names(turns: np.ndarray, p1: int, p2: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of the nodes along a path, the one that it starts from first."""
    return tuple(np.bitwise_xor.accumulate(np.r_[np.int64(p), turns[:, i]]) for p, i in ((p1, 3), (p2, 4)))


def _trie(table: pa.Table, stretch: int) -> list[pa.RecordBatch]:
    """What the sorted stretches of one level and opening say."""
    level, p1, p2 = (table.column(c)[0].as_py() for c in ("level", "p1", "p2"))
    row, turns = _paths(table)
    n, size = len(table), np.bincount(row)
    pos = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)

    def matrix(values, blank=0):
        out = np.full((n, int(size.max())), blank, dtype=np.int64)
        out[row, pos] = values
        return out
    codes = matrix(np.unique(turns[:, :2], axis=0, return_inverse=True)[1].ravel(), -1)  # dense turn ids
    chars = matrix(turns[:, 2])
    name1, name2 = (np.bitwise_xor.accumulate(matrix(turns[:, i]), 1) ^ np.int64(p) for i, p in ((3, p1), (4, p2)))
    convs, least, later = (table.column(c).to_numpy() for c in ("convs", "least", "later"))
    goes_on = table.column("goes_on").to_numpy()
    weight = np.cumsum(chars[:, ::-1], 1)[:, ::-1] * convs[:, None] + later[:, None]  # from here to the ends of all its conversations

    trie = DoubleArray(codes)
    of = {c: np.zeros(trie.used, dtype=np.int64) for c in ["parent", "depth", *_LONGS]}
    of["least"][:] = _NO_ID
    open_end = np.zeros(trie.used, dtype=bool)
    state, layers = np.zeros(n, dtype=np.int64), []
    for d in range(codes.shape[1]):
        rows = np.flatnonzero(codes[:, d] >= 0)
        below = trie.step(state[rows], codes[rows, d])
        of["parent"][below], of["depth"][below] = state[rows], d + 1
        for c, values in (("n1", name1), ("n2", name2), ("chars", chars)):
            of[c][below] = values[rows, d]
        np.add.at(of["convs"], below, convs[rows])
        np.add.at(of["weight"], below, weight[rows, d])
        np.minimum.at(of["least"], below, least[rows])
        open_end[below[(size[rows] == d + 1) & goes_on[rows]]] = True
        state[rows] = below
        layers.append(np.unique(below))
    of["owned"][:] = of["chars"]
    for layer in reversed(layers):
        of["leaves"][layer] += (of["children"][layer] == 0) & ~open_end[layer]
        for c in ("owned", "leaves"):
            np.add.at(of[c], of["parent"][layer], of[c][layer])
        np.add.at(of["children"], of["parent"][layer], 1)
    nodes = np.concatenate([[0], *layers])
    of["n1"][0], of["n2"][0] = p1, p2
    of["m1"], of["m2"] = of["n1"][of["parent"]], of["n2"][of["parent"]]
    out = []
    if level:  # the end of the stretch above: its own shard counts all but its children, and what hangs below is handed up
        out.append(_said(HANDED, 1, depth=level, least=int(least[0]), owned=int(of["owned"][0]), leaves=int(of["leaves"][0])))
        of["owned"][0] = of["leaves"][0] = 0
    else:
        of["convs"][0], of["weight"][0], of["least"][0] = convs.sum(), weight[:, 0].sum(), least.min()
    columns = {c: of[c][nodes] for c in _LONGS}
    for c in ("m1", "m2"):
        columns[c] = pa.array(columns[c], mask=nodes == 0)
    return [*out, _said(NODE, len(nodes), depth=(of["depth"][nodes] + level * stretch).astype(np.int32), **columns)]


def _counted_twice(last, first, stretch: int) -> list[pa.RecordBatch]:
    """What to take off for the nodes that two neighbouring stretches in different tries share; both are (level, p1, p2, least, goes_on, turns)."""
    if last is None or last[:3] != first[:3]:
        return []
    level, p1, p2, least = first[:4]
    old, new = last[5], first[5]
    short = min(len(old), len(new))
    same = (old[:short, :2] == new[:short, :2]).all(axis=1)
    n = short if same.all() else int(same.argmin())
    no_leaf = -int(n == len(old) and not last[4])  # its end was taken for a leaf
    if not n:
        return []
    owned = -np.cumsum(new[:n, 2][::-1])[::-1]
    owned, leaves = np.r_[owned[0], owned], np.full(n + 1, no_leaf)
    out = []
    if level:
        out.append(_said(HANDED, 1, depth=level, least=least, owned=int(owned[0]), leaves=no_leaf))
        owned[0] = leaves[0] = 0
    n1, n2 = _names(new[:n], p1, p2)
    return [*out, _said(NODE, n + 1, depth=(np.arange(n + 1) + level * stretch).astype(np.int32), n1=n1, n2=n2, owned=owned, leaves=leaves,
                        children=np.r_[np.full(n, -1), 0])]


def _end(table: pa.Table, at: int):
    one = table.slice(at, 1)
    return (*(one.column(c)[0].as_py() for c in ("level", "p1", "p2", "least", "goes_on")), _paths(one)[1])


def _edge(table: pa.Table, at: int, part: int, ending: bool) -> pa.RecordBatch:
    level, p1, p2, least, goes_on, _ = _end(table, at)
    path = table.column("path").slice(at, 1).combine_chunks()
    return _said(EDGE, 1, depth=level, n1=p1, n2=p2, least=least, part=part, ending=ending, goes_on=goes_on,
                 path=path.chunk(0) if isinstance(path, pa.ChunkedArray) else path)


def _shards(stretch: int, shard: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, waiting = TaskContext.get().partitionId(), None, []
        for batch in itertools.chain(batches, [None]):
            waiting += [batch] if batch is not None and len(batch) else []
            if not waiting or batch is not None and sum(map(len, waiting)) < shard:
                continue
            table, waiting = pa.Table.from_batches(waiting).combine_chunks(), []
            if last is None:
                yield _edge(table, 0, part, False)
            group = np.stack([table.column(c).to_numpy() for c in ("level", "p1", "p2")], 1)
            change = np.flatnonzero((group[1:] != group[:-1]).any(axis=1)) + 1
            cuts = np.unique(np.r_[0, change, np.arange(0, len(table), shard), len(table)])
            for low, high in itertools.pairwise(cuts.tolist()):
                yield from _counted_twice(last, _end(table, low), stretch)
                yield from _trie(table.slice(low, high - low).combine_chunks(), stretch)
                last = _end(table, high - 1)
            closing = table.slice(len(table) - 1)
        if last is not None:
            yield _edge(closing, 0, part, True)
    return run


# ---- turns and paths ----

def running(rows: DataFrame, key: str, **values) -> DataFrame:
    """``common.ranged`` rows, sorted by ``key`` first, with ``<name>_before`` of every value (an aggregate function and a column: F.sum or F.bit_xor)
    over the rows of the key before this one, and ``<name>_all``.  A key is split by ranges, however many rows it has."""
    def both(f, a: Column, b: Column) -> Column:
        return a.bitwiseXOR(b) if f is F.bit_xor else a + b
    parts = rows.groupBy(key, "__part").agg(*[f(c).alias(n) for n, (f, c) in values.items()])
    whole = Window.partitionBy(key)
    earlier = whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(key, "__part", *[F.coalesce(f(n).over(earlier), F.lit(0)).alias(f"__{n}") for n, (f, _) in values.items()],
                         *[f(n).over(whole).alias(f"{n}_all") for n, (f, _) in values.items()])
    inside = Window.partitionBy(key, "__part").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({f"{n}_before": F.coalesce(f(c).over(inside), F.lit(0)) for n, (f, c) in values.items()}).join(parts, [key, "__part"])
    return rows.withColumns({f"{n}_before": both(f, F.col(f"{n}_before"), F.col(f"__{n}")) for n, (f, _) in values.items()}).drop(
        "__part", "__at", *[f"__{n}" for n in values])


def placed_turns(conversations: DataFrame) -> DataFrame:
    """(conv, pos, x1, x2, chars) of all turns: hashes of (role, text) and its code points.  Texts are sorted, not carried on."""
    rows = conversations.select(F.coalesce(F.col("conv_id").cast("bigint"), F.lit(_NO_ID)).alias("conv"), "turn",
                                common.whole(F.col("role")).alias("role"), common.whole(F.col("text")).alias("text"))
    order = ["conv", "turn", "role"]
    rows = rows.repartitionByRange(*order, F.substring("text", 1, 64)).sortWithinPartitions(*order, "text")
    rows = cut_lineage(rows.select("conv", F.xxhash64("role", "text").alias("x1"), F.xxhash64("text", F.lit(1), "role").alias("x2"),
                                   F.length("text").cast("bigint").alias("chars"), F.monotonically_increasing_id().alias("__at"))
                       .withColumn("__part", F.shiftright("__at", 33)))
    return running(rows, "conv", pos=(F.sum, F.lit(1))).withColumnRenamed("pos_before", "pos").drop("pos_all")


def rebuilt(turns: DataFrame, lender: Column, borrowed: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations that open with turns of another one: (conv, n_turns, pos, x1, x2, chars) of their turns, and (conv, n_turns) of all.

    Conversation ``conv`` begins with the first ``borrowed`` turns (at most ``most``) of conversation ``lender``, or as many as there are, and goes on
    with its own after its first ``borrowed``.
    """
    turn = ["pos", "x1", "x2", "chars"]
    heads = turns.filter(F.col("pos") < most).groupBy(F.col("conv").alias("lender")).agg(F.sort_array(F.collect_list(F.struct(*turn))).alias("head"))
    convs = turns.groupBy("conv").agg(F.count("*").alias("own")).withColumns({"lender": lender, "h": borrowed}).join(heads, "lender", "left")
    convs = convs.withColumn("head", F.slice(F.coalesce("head", F.array().cast("array<struct<pos:bigint,x1:bigint,x2:bigint,chars:bigint>>")), 1, "h"))
    convs = cut_lineage(convs.select("conv", "h", "head", (F.size("head") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n_turns")))
    own = turns.join(convs.select("conv", "h", "n_turns", F.size("head").alias("m")), "conv").filter(F.col("pos") >= F.col("h"))
    own = own.select("conv", "n_turns", (F.col("pos") - F.col("h") + F.col("m")).alias("pos"), "x1", "x2", "chars")
    lent = convs.select("conv", "n_turns", F.explode("head").alias("t")).select("conv", "n_turns", "t.*")
    return own.unionByName(lent), convs.select("conv", "n_turns")


def stretches_of(turns: DataFrame, stretch: int) -> DataFrame:
    """(conv, n_turns, level, path, e1, e2, len, p1, p2, later): the stretches of all paths, hashes over them and what comes before, and the
    code points in them and after them."""
    turn = [F.col(c) for c in ("x1", "x2", "chars")] + [F.xxhash64("pos", "x1", "x2").alias("y1"), F.xxhash64("x2", "x1", "pos").alias("y2")]
    rows = turns.select("conv", "n_turns", F.expr(f"pos div {stretch}").cast("int").alias("level"), "pos", *turn)
    path = F.transform(F.sort_array(F.collect_list(F.struct("pos", "x1", "x2", "chars", "y1", "y2"))),
                       lambda t: F.struct(*[t[c].alias(c) for c in ("x1", "x2", "chars", "y1", "y2")]))
    rows = cut_lineage(rows.groupBy("conv", "n_turns", "level").agg(path.alias("path"), F.bit_xor("y1").alias("e1"), F.bit_xor("y2").alias("e2"),
                                                                    F.sum("chars").alias("len")))
    zero = F.lit(0).cast("bigint")
    short = rows.filter(F.col("n_turns") <= stretch).withColumns({"p1": zero, "p2": zero, "later": zero})
    long = common.ranged(rows.filter(F.col("n_turns") > stretch), ["conv", "level"])
    long = running(long, "conv", e1=(F.bit_xor, F.col("e1")), e2=(F.bit_xor, F.col("e2")), len=(F.sum, F.col("len")))
    return short.unionByName(long.select(*rows.columns, F.col("e1_before").alias("p1"), F.col("e2_before").alias("p2"),
                                         (F.col("len_all") - F.col("len_before") - F.col("len")).alias("later")))


def _along(stretch: int):
    """(level, p1, p2, path, owned, leaves) to NODE rows: the sums for every node on the path (and the root above the first)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for i in range(len(table)):
                level, p1, p2, owned, leaves = (batch.column(c)[i].as_py() for c in ("level", "p1", "p2", "owned", "leaves"))
                n1, n2 = _names(_paths(table.slice(i, 1).combine_chunks())[1], p1, p2)
                depth = np.arange(len(n1), dtype=np.int32) + level * stretch
                keep = slice(1 if level else 0, None)
                yield _said(NODE, len(n1[keep]), depth=depth[keep], n1=n1[keep], n2=n2[keep], owned=np.full(len(n1[keep]), owned),
                            leaves=np.full(len(n1[keep]), leaves))
    return run


def digests(ends: DataFrame) -> DataFrame:
    """(depth, n1, n2, ends_sha256) of (conv, depth, n1, n2): ids of a node are sorted over all tasks and joined IDS at a time; one task hashes the
    joined pieces of a node as they come."""
    node = ["n1", "n2", "depth"]
    rows = common.ranged(ends.filter(F.col("conv") != _NO_ID), [*node, "conv"])
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    pieces = rows.groupBy(*node, F.expr(f"__at div {IDS}").alias("piece")).agg(ids.alias("ids"), F.min("conv").alias("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in itertools.chain(batches, [None]):
            out = []
            for *name, ids in zip(*(batch.column(c).to_pylist() for c in (*node, "ids"))) if batch is not None else [(None,) * 4]:
                if name != now:
                    if state is not None:
                        out.append((*now, state.hexdigest()))
                    now, state = name, hashlib.sha256()
                else:
                    state.update(b",")
                state.update((ids or "").encode())
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=[*node, "ends_sha256"])
    pieces = pieces.repartition("n1", "n2").sortWithinPartitions(*node, "first").select(*node, "ids")
    return pieces.mapInArrow(run, "n1 bigint, n2 bigint, depth int, ends_sha256 string")


def trie(turns: DataFrame, convs: DataFrame, stretch: int = STRETCH, shard: int = SHARD) -> DataFrame:
    """The nodes of the prefix trie of (conv, n_turns, pos, x1, x2, chars) with all conversations (conv, n_turns), also those without turns.

    Per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens (over the subtree, conversations beyond
    the first times code points of the last text), ends_sha256 (of the sorted ids that end here).  Without conversations there is no node.
    """
    rows = cut_lineage(stretches_of(turns, stretch))
    goes_on = F.col("n_turns") > (F.col("level") + 1) * stretch
    group = ["level", "p1", "p2"]
    merged = rows.groupBy(*group, "e1", "e2").agg(F.first("path").alias("path"), F.count("*").alias("convs"), F.min("conv").alias("least"),
                                                  F.sum("later").alias("later"), F.max(goes_on).alias("goes_on"))
    merged = cut_lineage(merged.withColumn("key", F.transform("path", lambda t: F.struct(t["x1"].alias("x1"), t["x2"].alias("x2")))))
    order = [*group, "key"]
    shards = merged.repartitionByRange(*order).sortWithinPartitions(*order).drop("key", "e1", "e2")
    said = cut_lineage(shards.mapInArrow(_shards(stretch, shard), _SAID))

    # The ends of neighbouring tasks, two rows a task.
    ends_of = F.struct("depth", "n1", "n2", "least", "goes_on", "path", "part")
    seam = said.filter(F.col("kind") == EDGE).withColumn("old", F.lag(ends_of).over(Window.orderBy("part", "ending")))
    seam = seam.filter(~F.col("ending") & F.col("old").isNotNull()).select(ends_of.alias("new"), "old")

    def sewn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pair in batch.to_pylist():
                last, first = ((e["depth"], e["n1"], e["n2"], e["least"], e["goes_on"],
                                np.array([list(t.values()) for t in e["path"]], dtype=np.int64)) for e in (pair["old"], pair["new"]))
                yield from _counted_twice(last, first, stretch)
    off = cut_lineage(seam.mapInArrow(sewn, _SAID))

    # What hangs below level ``depth`` of a conversation, for every stretch above that.
    both = said.unionByName(off)
    handed = both.filter(F.col("kind") == HANDED).groupBy(F.col("least").alias("conv"), F.col("depth").alias("level")).agg(
        F.sum("owned").alias("owned"), F.sum("leaves").alias("leaves"))
    handed = cut_lineage(handed)
    carriers = rows.filter(F.col("n_turns") > stretch).join(handed.select("conv").distinct(), "conv").join(handed, ["conv", "level"], "left")
    carriers = common.ranged(carriers.select("conv", *group, "path", F.coalesce("owned", F.lit(0)).alias("owned"),
                                             F.coalesce("leaves", F.lit(0)).alias("leaves")), ["conv", "level"])
    carriers = running(carriers, "conv", owned=(F.sum, F.col("owned")), leaves=(F.sum, F.col("leaves")))
    above = carriers.select(*group, "path", *[(F.col(f"{c}_all") - F.col(f"{c}_before") - F.col(c)).alias(c) for c in ("owned", "leaves")])
    above = above.filter("owned <> 0 or leaves <> 0").mapInArrow(_along(stretch), _SAID)

    zero = F.lit(0).cast("bigint")
    silent = convs.filter("n_turns = 0").agg(F.count("*").alias("convs"), F.min("conv").alias("least"))
    columns = ["depth", *_LONGS]
    silent = silent.select(F.lit(0).alias("depth"), *[F.col(c) if c in ("convs", "least") else (F.lit(None).cast("bigint") if c in ("m1", "m2") else zero).alias(c)
                                                      for c in _LONGS])
    parts = both.filter(F.col("kind") == NODE).select(columns).unionByName(above.select(columns)).unionByName(silent)
    node = ["depth", "n1", "n2"]
    nodes = cut_lineage(parts.groupBy(*node).agg(*[F.max(c).alias(c) for c in ("m1", "m2")], F.min("least").alias("least"),
                                                 *[F.sum(c).alias(c) for c in _SUMS]).filter("convs > 0"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("n1").alias("m1"), F.col("n2").alias("m2"), F.col("least").alias("parent"))
    last = rows.filter(F.col("level") == F.expr(f"(n_turns - 1) div {stretch}")).select(
        "conv", F.col("n_turns").cast("int").alias("depth"), F.col("p1").bitwiseXOR(F.col("e1")).alias("n1"), F.col("p2").bitwiseXOR(F.col("e2")).alias("n2"))
    last = last.unionByName(convs.filter("n_turns = 0").select("conv", F.lit(0).alias("depth"), zero.alias("n1"), zero.alias("n2")))
    found = nodes.join(parents, ["depth", "m1", "m2"], "left").join(digests(last), node, "left")

    def conv_id(c: str) -> Column:
        return F.when(F.col(c) != _NO_ID, F.col(c))
    return found.select(conv_id("least").alias("conv_id"), F.col("depth").cast("bigint").alias("depth"), conv_id("parent").alias("parent_conv_id"),
                        F.col("convs").alias("n_convs"), F.col("children").alias("n_children"),
                        F.when(F.col("children") == 0, 1).otherwise(F.col("leaves")).cast("bigint").alias("n_leaves"),
                        (F.col("weight") - F.col("owned")).alias("saved_tokens"),
                        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame, stretch: int = STRETCH, shard: int = SHARD) -> DataFrame:
    """The trie of ``conversations`` (conv_id, turn, role, text; further columns are ignored), each rebuilt: conversation c opens with the first h turns
    of conversation c - c % 100, h = crc32 of the decimal c, modulo 6, in place of its own first h.

    Turns are ordered by turn, null first, then role and text; null roles and texts are empty; repeated rows are repeated turns.  Rows with a null
    conv_id are one conversation, which borrows nothing, is named last (null) and is left out of ``ends_sha256``.  An empty table gives no rows.
    """
    conv = F.col("conv")
    named = conv != _NO_ID
    turns, convs = rebuilt(placed_turns(conversations), F.when(named, conv - conv % 100),
                           F.when(named, F.crc32(conv.cast("string").cast("binary")) % 6).otherwise(0).cast("int"), 5)
    return trie(turns, convs, stretch, shard)


def query(spark, sf_dir: str) -> DataFrame:
    return conversation_trie(common.table(spark, sf_dir, "conversations"))


SQL = r"""
WITH own AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i,
           {'r': coalesce(role, ''), 't': coalesce(text, '')} AS turn FROM conversations),
lists AS (SELECT conv_id, list(turn ORDER BY i) AS turns FROM own GROUP BY conv_id),
hashed AS (SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
                  lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                      lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END)), 4294967295::BIGINT) % 6 AS h FROM lists),
paths AS (SELECT c.conv_id, list_concat(coalesce(b.turns, [])[1:c.h], c.turns[c.h + 1:]) AS turns
          FROM hashed c LEFT JOIN lists b ON b.conv_id = c.conv_id - c.conv_id % 100),
steps AS (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM paths),
named AS (SELECT conv_id, depth, md5(CAST(to_json(turns[1:depth]) AS VARCHAR)) AS node, md5(CAST(to_json(turns[1:depth - 1]) AS VARCHAR)) AS parent,
                 depth = len(turns) AS last, CASE WHEN depth > 0 THEN len(turns[depth].t) ELSE 0 END AS chars FROM steps),
nodes AS (SELECT depth, node, CASE WHEN depth > 0 THEN any_value(parent) END AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
                 sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256
          FROM named GROUP BY depth, node),
kids AS (SELECT n.*, (SELECT count(*) FROM nodes k WHERE k.parent = n.node AND k.depth = n.depth + 1) AS n_children FROM nodes n),
above AS (SELECT DISTINCT a.depth, a.node, b.depth AS low, b.node AS below FROM named a JOIN named b ON a.conv_id = b.conv_id AND a.depth <= b.depth),
sums AS (SELECT a.depth, a.node, count(*) FILTER (k.n_children = 0) AS n_leaves, sum((k.n_convs - 1) * k.chars) AS saved
         FROM above a JOIN kids k ON k.depth = a.low AND k.node = a.below GROUP BY a.depth, a.node)
SELECT k.conv_id, CAST(k.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(k.n_convs AS BIGINT) AS n_convs, CAST(k.n_children AS BIGINT) AS n_children,
       CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, k.ends_sha256
FROM kids k JOIN sums s ON s.depth = k.depth AND s.node = k.node LEFT JOIN nodes p ON p.depth = k.depth - 1 AND p.node = k.parent
"""
