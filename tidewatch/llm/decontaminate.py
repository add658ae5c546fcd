"""Benchmark decontamination by latent semantic retrieval.

1. Texts become 32-bit word hashes once, written to the shared folder; the later passes read these.
2. Document frequencies of FEATURES hashed terms over all passages of BLOCK words give the idf weights.
3. Randomised SVD of the TF-IDF passage matrix A: with a sparse random test matrix W every task adds up its share of Z = A'(A W); from Z and W alone follow the
   leading right singular vectors and values (A'A ~ Z (W'Z)^-1 Z').  All passages count; only FEATURES x RANK numbers leave the executors.
4. Benchmark items, a block of them at a time, are projected to the latent space and compared by cosine with windows of all texts, whose vectors are differences
   of running sums.  The window is the smallest of SCALES that holds the item; a word counts once in each STRIDE words, so that
   repeated words beside a leak do not drown it.
   Items of fewer than SHORT words are too small a part of a window: they are found by the hashes of their words, at every place of the texts.
5. Near windows are checked word by word: bag overlap, then the longest common subsequence with the item, and for paraphrases also
   whether the item's last sentence, taken for its answer, is there.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import common
from tidewatch.session import arrow_rows, cut_lineage

FEATURES = 8192
RANK, OVERSAMPLE = 104, 8
#: Places of a feature's signs in the sparse random test matrix.
SIGNS = 4
BLOCK = 32
SCALES = (16, 24, 32, 48, 64)
STRIDE = 8
#: Cosine in the latent space from which a window is read.
NEAR = 0.4
#: Share of an item's words that must follow each other in the window: alone, and with the answer.
VERBATIM, PARAPHRASE = 0.8, 0.6
#: Share of the answer's words that a paraphrase must hold.
ANSWER = 0.5
#: Shorter items are leaked by a verbatim copy only.
SHORT = 8
#: Items searched in one pass over the corpus; bounds what a task holds besides its texts.
ITEMS_PER_PASS = 2000
#: Words that are worked on at a time.
CHUNK_WORDS = 100_000
#: Bytes of text that are split at a time, which takes some 25 times as much memory; a longer text is split alone.
CHUNK_BYTES = 4 << 20
#: Texts or their words sent to Python at a time while the words are made and the decomposition runs.
ROWS = 1000
#: Bytes of words that are hashed at a time, which takes some 50 times as much memory.
HASH_BYTES = 1 << 16
#: A longer text is searched in pieces that overlap by so many words.
OVERLAP = 2 * SCALES[-1]

#: What is cut off a word at either end: all but letters, digits and underscores.
EDGE = r"^[^\pL\pN_]+|[^\pL\pN_]+$"
_BASE = 0x9E3779B97F4A7C15


def _string_hashes(words: pa.Array) -> np.ndarray:
    """64-bit hashes of all strings of an array at once: powers of a base over their bytes, from running sums of HASH_BYTES at a time."""
    offsets = np.frombuffer(words.buffers()[1], dtype=np.int32)[words.offset: words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2] or b"", dtype=np.uint8)[offsets[0]: offsets[-1]]
    at = offsets - offsets[0]
    size = min(HASH_BYTES, len(data) + 1)
    up, down = np.full(size + 1, np.uint64(_BASE)), np.full(size + 1, np.uint64(pow(_BASE, -1, 1 << 64)))
    up[0] = down[0] = 1
    np.cumprod(up, out=up)
    np.cumprod(down, out=down)
    sums, back = np.empty(len(at), np.uint64), np.empty(len(at), np.uint64)
    # the sum of all bytes before a block, and the powers at its first byte
    before, power, inverse = np.zeros(1, np.uint64), up[:1].copy(), down[:1].copy()
    for low in range(0, len(data) + 1, size):
        part = data[low: low + size].astype(np.uint64) + np.uint64(1)
        part *= up[:len(part)]
        running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part)])
        first, last = np.searchsorted(at, (low, low + size))
        inside = at[first:last] - low
        sums[first:last] = before + power * running[inside]
        back[first:last] = inverse * down[inside]
        before, power, inverse = before + power * running[-1:], power * up[-1:], inverse * down[-1:]
    out = (sums[1:] - sums[:-1]) * back[:-1]
    out = (out ^ (out >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(29))


def split_ids(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(32-bit hashes of all words of the texts in a row, offsets of the texts).  Words are in lower case and without punctuation at their ends; nothing
    but punctuation is no word.  Arrow splits at white space and finds the distinct words, so each of these is hashed once."""
    parts = pa.compute.utf8_split_whitespace(pa.compute.fill_null(texts, ""))
    words = parts.flatten().dictionary_encode()
    plain = pa.compute.replace_substring_regex(pa.compute.utf8_lower(words.dictionary), EDGE, "")
    empty = pa.compute.equal(plain, "").to_numpy(zero_copy_only=False)
    known = np.where(empty, 0, (_string_hashes(plain) >> np.uint64(32)) | np.uint64(1)).astype(np.uint32)
    ids = known[words.indices.to_numpy()]
    before = np.concatenate([[0], np.cumsum(ids != 0)])
    offsets = parts.offsets.to_numpy()
    return ids[ids != 0], before[offsets - offsets[0]]


def word_ids(text: str | None) -> np.ndarray:
    return split_ids(pa.array([text], pa.string()))[0]


def _hashed_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text_key, words) of (doc_id, text_key, text), CHUNK_BYTES of text at a time."""
    for batch in batches:
        sizes = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(batch.column(2)), 0).to_numpy())
        cuts = [0, *(np.flatnonzero(np.diff(sizes // CHUNK_BYTES)) + 1).tolist(), len(batch)]
        for low, high in itertools.pairwise(cuts):
            ids, offsets = split_ids(batch.column(2)[low:high])
            places = pa.py_buffer((4 * offsets).astype(np.int32))
            words = pa.Array.from_buffers(pa.binary(), high - low, [None, places, pa.py_buffer(np.ascontiguousarray(ids))])
            yield pa.RecordBatch.from_arrays([batch.column(0)[low:high], batch.column(1)[low:high], words], names=["doc_id", "text_key", "words"])


def hashed(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, words) of every row: the verdict depends on the text alone, and the key names the text."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_key().alias("text_key"), F.col("text").cast("string").alias("text"))

    with arrow_rows(docs.sparkSession, ROWS):
        return cut_lineage(rows.mapInArrow(_hashed_batches, "doc_id bigint, text_key string, words binary"))


def text_key():
    return F.md5(common.whole(F.col("text")))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The texts' words in lists of about CHUNK_WORDS."""
    held, n = [], 0
    for batch in batches:
        for value in batch.column(0):
            held.append(np.frombuffer(value.as_py(), dtype=np.uint32))
            n += len(held[-1])
            if n >= CHUNK_WORDS:
                yield held
                held, n = [], 0
    if held:
        yield held


def _passages(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(passage, feature, count) of the distinct features of every passage, sorted; passages are numbered from 0."""
    ids = np.concatenate(texts) if texts else np.empty(0, np.uint32)
    sizes = np.array([len(t) for t in texts])
    per_text = -(-sizes // BLOCK)
    first_word, first_passage = np.cumsum(sizes) - sizes, np.cumsum(per_text) - per_text
    inside = np.arange(len(ids)) - np.repeat(first_word, sizes)
    passage = np.repeat(first_passage, sizes) + inside // BLOCK
    cells, counts = np.unique(passage * FEATURES + (ids % FEATURES).astype(np.int64), return_counts=True)
    return cells // FEATURES, cells % FEATURES, counts


def _added(partials: DataFrame, length: int) -> np.ndarray:
    """The sum of float64 vectors (piece, source, data) by piece, joined in order; two levels, so that no task holds many of them."""
    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(x, dtype=np.float64) for x in rows["data"]], axis=0)
        return pd.DataFrame({"piece": [rows["piece"].iloc[0]], "source": [0], "data": [total.tobytes()]})
    kind = "piece int, source int, data binary"
    some = partials.withColumn("source", F.col("source") % 64).groupBy("piece", "source").applyInPandas(add, kind)
    rows = some.groupBy("piece").applyInPandas(add, kind).collect()  # FEATURES x (RANK + OVERSAMPLE) numbers at most
    flat = [np.frombuffer(r["data"], dtype=np.float64) for r in sorted(rows, key=lambda r: r["piece"])]
    return np.concatenate(flat) if flat else np.zeros(length)


def _pieces(total: np.ndarray, pieces: int) -> pa.RecordBatch:
    from pyspark import TaskContext
    parts = np.split(total.ravel(), pieces)
    source = TaskContext.get().partitionId()
    return pa.RecordBatch.from_arrays(
        [pa.array(range(pieces), pa.int32()), pa.array([source] * pieces, pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())],
        names=["piece", "source", "data"])


def _few_tasks(words: DataFrame) -> DataFrame:
    """Every task sends one sum, so there need not be more tasks than a few per core."""
    return words.select("words").coalesce(4 * words.sparkSession.sparkContext.defaultParallelism)


def idf_weights(words: DataFrame) -> np.ndarray:
    def run(batches):
        total = np.zeros(FEATURES + 8)
        for texts in _chunks(batches):
            passage, feature, _ = _passages(texts)
            total[:FEATURES] += np.bincount(feature, minlength=FEATURES)
            total[FEATURES] += passage[-1] + 1 if len(passage) else 0
        yield _pieces(total, 1)
    total = _added(_few_tasks(words).mapInArrow(run, "piece int, source int, data binary"), FEATURES + 8)
    return np.log((1 + total[FEATURES]) / (1 + total[:FEATURES])) + 1


def latent_map(words: DataFrame) -> np.ndarray:
    """FEATURES x RANK: what a word adds to a passage's whitened latent vector."""
    idf = idf_weights(words)
    width = RANK + OVERSAMPLE
    dice = np.random.default_rng(12345)
    place, sign = dice.integers(0, width, (FEATURES, SIGNS)), dice.choice([-1.0, 1.0], (FEATURES, SIGNS))
    test = np.zeros((FEATURES, width))
    np.add.at(test, (np.repeat(np.arange(FEATURES), SIGNS), place.ravel()), sign.ravel())
    sent = words.sparkSession.sparkContext.broadcast((idf, place, sign))

    def run(batches):
        idf, place, sign = sent.value
        total = np.zeros((width, FEATURES))
        for texts in _chunks(batches):
            passage, feature, count = _passages(texts)
            if not len(passage):
                continue
            start = np.flatnonzero(np.diff(passage, prepend=-1))
            weight = count * idf[feature]
            norm = np.sqrt(np.add.reduceat(weight * weight, start))
            row = np.cumsum(np.diff(passage, prepend=-1) > 0) - 1
            weight /= norm[row]
            cells = (place[feature] * len(start) + row[:, None]).ravel()
            image = np.bincount(cells, (sign[feature] * weight[:, None]).ravel(), width * len(start)).reshape(width, -1)  # (A W)'
            added = np.empty(len(row))
            for d in range(width):
                np.multiply(weight, image[d].take(row, out=added, mode="clip"), out=added)
                total[d] += np.bincount(feature, added, FEATURES)
        yield _pieces(total, width)
    z = _added(_few_tasks(words).mapInArrow(run, "piece int, source int, data binary"), width * FEATURES).reshape(width, FEATURES).T
    core = test.T @ z
    value, vector = np.linalg.eigh((core + core.T) / 2)
    good = value > max(value.max(), 1e-12) * 1e-9
    half = z @ (vector[:, good] / np.sqrt(value[good]))  # half @ half.T ~ A'A
    u, s, _ = np.linalg.svd(half, full_matrices=False)
    u, s = u[:, :RANK], s[:RANK]
    return np.vstack([idf[:, None] * u / np.maximum(s, 1e-9), np.zeros((1, len(s)))]).astype(np.float32)


def strides(words: np.ndarray, words_to_latent: np.ndarray) -> np.ndarray:
    """The latent sum of every STRIDE words, each word once; the map's last row is for what does not count."""
    return strides_of([words], words_to_latent)[0]


def strides_of(texts: list[np.ndarray], words_to_latent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(``strides`` of the texts one after the other, how many each has)."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    sizes = -(-lengths // STRIDE)
    rows = np.full(sizes.sum() * STRIDE, FEATURES, dtype=np.int32)
    if len(rows):
        # a text's first word moves on by what pads the texts before it
        moved = np.cumsum(sizes * STRIDE - lengths) - (sizes * STRIDE - lengths)
        rows[np.arange(lengths.sum()) + np.repeat(moved, lengths)] = np.concatenate(texts) % FEATURES
    rows = np.ascontiguousarray(rows.reshape(-1, STRIDE).T)
    distinct = rows.copy()
    for a in range(1, STRIDE):
        again = rows[0] == rows[a]
        for b in range(1, a):
            again |= rows[b] == rows[a]
        distinct[a][again] = FEATURES
    out = np.empty((len(distinct[0]), words_to_latent.shape[1]), dtype=words_to_latent.dtype)
    for low in range(0, len(out), 1024):  # a part of the sums that stays in the cache
        part = out[low: low + 1024]
        part[:] = words_to_latent.take(distinct[0][low: low + 1024], axis=0)
        for a in range(1, STRIDE):
            part += words_to_latent.take(distinct[a][low: low + 1024], axis=0)
    return out, sizes


def _runs(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of every n words that follow each other."""
    out = np.zeros(max(len(words) - n + 1, 0), dtype=np.uint64)
    for i in range(n):
        out = (out ^ words[i: i + len(out)]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


class Items:
    """A block of benchmark items, ready to be searched for: words, answers, and unit latent vectors by scale, or hashes of the short ones."""

    def __init__(self, rows: list[tuple[int, str | None]], words_to_latent: np.ndarray):
        self.ids, self.words, self.answers, self.kinds = [], [], [], []
        self.counts: list[dict[int, int]] = []
        by_scale: dict[int, list] = {s: [] for s in SCALES}
        short: dict[int, dict[int, list[int]]] = {}
        for item_id, text in rows:
            w = word_ids(text)
            if not len(w):
                continue
            i = len(self.ids)
            self.ids.append(item_id)
            self.words.append(w)
            self.answers.append(self._answer(text, w))
            self.kinds.append(np.unique(w, return_counts=True))
            self.counts.append(dict(zip(*(x.tolist() for x in self.kinds[-1]))))
            if len(w) < SHORT:
                short.setdefault(len(w), {}).setdefault(int(_runs(w, len(w))[0]), []).append(i)
                continue
            for offset in range(0, len(w), SCALES[-1]):
                piece = w[offset: offset + SCALES[-1]]
                if offset and len(piece) < SCALES[0] // 2:
                    break
                scale = next(s for s in SCALES if len(piece) <= s)
                by_scale[scale].append((i, offset, strides(piece, words_to_latent).sum(axis=0)))
        #: Items of fewer than SHORT words: their number of words, the sorted hashes of these, and the items by hash.
        self.short = [(n, np.array(sorted(by_hash), dtype=np.uint64), by_hash) for n, by_hash in sorted(short.items())]
        self.queries = {}
        for scale, found in by_scale.items():
            if found:
                v = np.array([f[2] for f in found])
                v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)
                self.queries[scale] = (np.array([f[0] for f in found]), np.array([f[1] for f in found]), v.T.copy())

    @staticmethod
    def _answer(text: str, w: np.ndarray) -> np.ndarray:
        sentences = [s for s in re.split(r"(?<=[.!?])\s+", text.strip()) if s]
        last = word_ids(sentences[-1]) if len(sentences) > 1 else w[-5:]
        return last if len(last) else w[-5:]


def common_subsequence(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, by bit vectors over ``a``."""
    places: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    free = full
    for x in b.tolist():
        if hit := places.get(x):
            u = free & hit
            free = ((free + u) | (free - u)) & full
    return len(a) - free.bit_count()


def _bag(kinds: tuple[np.ndarray, np.ndarray], window: np.ndarray) -> int:
    """Words of the item that the window holds, each as often as both have it."""
    names, counts = kinds
    at = np.minimum(np.searchsorted(names, window), len(names) - 1)
    return int(np.minimum(np.bincount(at[names[at] == window], minlength=len(names)), counts).sum())


def judge(item: np.ndarray, answer: np.ndarray, span: np.ndarray, kinds=None) -> tuple[int, bool]:
    """(common words in order, leaked)."""
    n = len(item)
    if n < SHORT:
        copied = len(span) >= n and (np.lib.stride_tricks.sliding_window_view(span, n) == item).all(axis=1).any()
        return (n, True) if copied else (0, False)
    if _bag(kinds or np.unique(item, return_counts=True), span) < PARAPHRASE * n:
        return 0, False
    same = common_subsequence(item, span)
    if same >= VERBATIM * n:
        return same, True
    return same, same >= PARAPHRASE * n and _bag(np.unique(answer, return_counts=True), span) >= ANSWER * len(answer)


def verbatim(texts: list[np.ndarray], items: Items) -> dict[tuple[int, int], int]:
    """The short items that stand in the texts word by word, as ``found_in`` gives them; no vector is asked."""
    out: dict[tuple[int, int], int] = {}
    if not items.short:
        return out
    words = np.concatenate(texts)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    for n, hashes, by_hash in items.short:
        runs = _runs(words, n)
        near = np.minimum(np.searchsorted(hashes, runs), len(hashes) - 1)
        at = np.flatnonzero(hashes[near] == runs)
        at = at[owner[at] == owner[at + n - 1]]
        for p in at.tolist():
            for i in by_hash[int(runs[p])]:
                key = (int(owner[p]), i)
                if key not in out and (words[p: p + n] == items.words[i]).all():
                    out[key] = n
    return out


def found_in(texts: list[np.ndarray], items: Items, words_to_latent: np.ndarray) -> dict[tuple[int, int], int]:
    """(place in ``texts``, place in ``items``) of the leaks, with the length of the common subsequence."""
    owners, froms, vectors = [], [], []
    for t, words in enumerate(texts):
        for low in range(0, max(len(words) - OVERLAP, 1), CHUNK_WORDS):
            owners.append(t)
            froms.append(low)
            vectors.append(words[low: low + CHUNK_WORDS + OVERLAP])
    if not any(len(v) for v in vectors):
        return {}
    each, sizes = strides_of(vectors, words_to_latent)
    first = np.cumsum(sizes) - sizes
    sums = np.concatenate([np.zeros((1, words_to_latent.shape[1]), dtype=np.float32), each])
    np.cumsum(sums, axis=0, out=sums)
    piece = np.repeat(np.arange(len(sizes)), sizes)
    stop = np.repeat(first + sizes, sizes)
    every = np.arange(len(piece))
    text_of, starts = np.array(owners), np.array(froms)
    best = verbatim(texts, items)
    listed: dict[int, list[int]] = {}
    for scale, (owner, offset, queries) in items.queries.items():
        step = scale // STRIDE
        # a window that the text's end cuts short lies in an earlier one, but for the first
        whole = every + step <= stop
        short = every[~whole & (every == first[piece])]
        for low in range(0, len(every), 4096):
            at = every[low: min(low + 4096, len(every) - step)]  # windows that follow each other: two slices of the sums
            v = sums[low + step: low + step + len(at)] - sums[low: low + len(at)]
            counts = whole[at]
            if low == 0 and len(short):
                at, counts = np.concatenate([at, short]), np.concatenate([counts, np.ones(len(short), dtype=bool)])
                v = np.concatenate([v, sums[stop[short]] - sums[short]])
            length = np.sqrt(np.einsum("ij,ij->i", v, v))
            bar = np.where(counts, NEAR * np.maximum(length, 1e-9), np.inf).astype(np.float32)
            rows, hits = np.divmod(np.flatnonzero(v @ queries >= bar[:, None]), queries.shape[1])
            windows = at[rows]
            pieces = piece[windows]
            begins = starts[pieces] + (windows - first[pieces]) * STRIDE - offset[hits]
            for t, i, begin in zip(text_of[pieces].tolist(), owner[hits].tolist(), begins.tolist()):
                key = (t, i)
                item = items.words[i]
                if best.get(key, 0) == len(item):
                    continue
                slack = max(STRIDE, len(item) // 4)
                low_end, high_end = max(0, begin - slack), begin + max(scale, len(item)) + slack
                if t not in listed:
                    listed[t] = texts[t].tolist()
                wanted = items.counts[i]
                if sum(map(wanted.__getitem__, wanted.keys() & set(listed[t][low_end:high_end]))) < PARAPHRASE * len(item):
                    continue
                span = texts[t][low_end:high_end]
                same, leaked = judge(item, items.answers[i], span, items.kinds[i])
                if leaked:
                    best[key] = max(best.get(key, 0), same)
    return best


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text_key, item_id, same_words, item_words): every row of ``docs`` (doc_id, text) and item of ``benchmark`` (item_id, text) it holds.

    Null or empty texts and items match nothing; repeated rows are reported one by one, repeated items under each of their ids, null ids as null; an
    empty table on either side gives no rows; further columns are ignored.  Items of fewer than SHORT words must stand there verbatim.
    """
    words = hashed(docs)
    spark = words.sparkSession
    kind = "doc_id bigint, text_key string, item_id bigint, same_words bigint, item_words bigint"
    out = spark.createDataFrame([], kind)
    rows = ((r["item_id"], r["text"]) for r in benchmark.select(F.col("item_id").cast("bigint").alias("item_id"),
                                                                F.col("text").cast("string").alias("text")).toLocalIterator())
    latent = None
    while block := list(itertools.islice(rows, ITEMS_PER_PASS)):
        if latent is None:
            with arrow_rows(spark, ROWS):
                latent = latent_map(words)
        sent = spark.sparkContext.broadcast((Items(block, latent), latent))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            items, latent = sent.value
            for batch in batches:
                sizes = pa.compute.binary_length(batch.column(2)).to_numpy(zero_copy_only=False) // 4
                cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(sizes) // CHUNK_WORDS)) + 1).tolist(), len(sizes)]
                hits = []
                for low, high in itertools.pairwise(cuts):
                    texts = [np.frombuffer(v.as_py(), dtype=np.uint32) for v in batch.column(2)[low:high]]
                    for (t, i), same in found_in(texts, items, latent).items():
                        hits.append((batch.column(0)[low + t].as_py(), batch.column(1)[low + t].as_py(), items.ids[i], same, len(items.words[i])))
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([h[c] for h in hits], k) for c, k in enumerate(kinds)],
                                                 names=["doc_id", "text_key", "item_id", "same_words", "item_words"])
        out = out.unionByName(words.mapInArrow(run, kind))
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark item, with all their columns."""
    found = cut_lineage(leaks(docs, benchmark)).select(F.col("text_key").alias("__key")).distinct()
    return docs.withColumn("__key", text_key()).join(found, "__key", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    found = leaks(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "same_words", "item_words")
