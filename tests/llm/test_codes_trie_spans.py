"""Vector codes, the prefix trie and span removal against brute force, with nulls, ties, repeated rows, empty tables and clashing columns."""

import collections
import hashlib
import itertools
import zlib

import numpy as np
import pytest

from tidewatch.llm import spans, turntrie, vectorcodes


# ---- vector codes ----

VECTORS = "vec_id bigint, embedding array<double>, label int, code string, row string, v int, error string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, e, l, "x", "y", 1, "z") for i, e, l in rows], VECTORS)


def coded_by_hand(rows, coding):
    kept = [(i, l, [int(np.floor(coding.scale * x)) for x in e]) for i, e, l in rows
            if e and all(x is not None and np.isfinite(x) for x in e)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    kept = [r for r in kept if len(r[2]) == len(kept[0][2])]
    width = -(-len(kept[0][2]) // coding.parts)
    data = np.array([r[2] + [0] * (width * coding.parts - len(r[2])) for r in kept], dtype=object).reshape(len(kept), coding.parts, width)
    books = [[list(data[i, p]) for i in range(min(coding.entries, len(kept)))] for p in range(coding.parts)]

    def nearest(p, x):
        gaps = [sum((a - b) ** 2 for a, b in zip(x, e)) for e in books[p]]
        return gaps.index(min(gaps)), min(gaps)
    for _ in range(coding.rounds):
        for p in range(coding.parts):
            own = collections.defaultdict(list)
            for i in range(len(kept)):
                own[nearest(p, data[i, p])[0]].append(data[i, p])
            for e, points in own.items():
                books[p][e] = [sum(c) // len(points) for c in zip(*points)]
    codes = [[nearest(p, data[i, p]) for p in range(coding.parts)] for i in range(len(kept))]
    errors = [sum(int(g) for _, g in c) for c in codes]
    by_label = collections.Counter()
    for (_, label, _), e in zip(kept, errors):
        by_label[label] += e
    digest = hashlib.sha256(",".join(str(int(x)) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted((str(k[0]), "".join(f"{e:02x}" for e, _ in c), err, by_label[k[1]], digest) for k, c, err in zip(kept, codes, errors))


@pytest.mark.parametrize("coding,size", [(vectorcodes.Coding(), 16), (vectorcodes.Coding(parts=4, entries=5, rounds=3, scale=100), 10),
                                         (vectorcodes.Coding(parts=2, entries=20, rounds=2), 2)])
def test_codes_against_brute_force(spark, coding, size):
    rng = np.random.default_rng(size)
    rows = [(int(i), [float(x) for x in rng.normal(0, 0.3, size).round(2)], int(i) % 3 if i % 7 else None) for i in rng.permutation(60)]
    rows += [(100, rows[0][1], 1), (3, rows[1][1], 2), (3, rows[1][1], 2), (None, rows[2][1], None), (101, [0.0] * size, 1), (102, [-50.0] * size, 1)]
    rows += [(103 + i, rows[3][1], 0) for i in range(300)]  # equal vectors fill blocks
    rows += [(-5, None, 1), (-4, [], 1), (-3, [None] + [1.0] * (size - 1), 1), (-2, [float("nan")] * size, 1), (-1, [float("inf")] * size, 1),
             (900, [1.0] * (size + 1), 1)]
    got = vectorcodes.coded(vectors(spark, rows).repartition(3), coding).collect()
    assert sorted((str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in got) == coded_by_hand(rows, coding)


def test_few_no_and_too_large_vectors(spark):
    few = [(5, [0.5] * 8, 1), (4, [-0.25] * 8, None)]
    got = vectorcodes.coded(vectors(spark, few)).collect()
    assert sorted((str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in got) == coded_by_hand(few, vectorcodes.Coding())
    empty = vectorcodes.coded(vectors(spark, [(1, None, 1)]))
    assert empty.count() == 0 and empty.columns == ["vec_id", "label", "code", "error", "label_error", "codebooks_sha256"]
    with pytest.raises(ValueError):
        vectorcodes.coded(vectors(spark, [(1, [1e12] * 8, 1)]))


def test_hilbert_neighbours_and_shortlists():
    grid = np.array(list(itertools.product(range(4), repeat=4)))
    keys = vectorcodes.hilbert_keys(grid, 2)
    assert sorted(keys.tolist()) == list(range(256)) and (np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(1) == 1).all()
    rng = np.random.default_rng(1)
    entries = rng.integers(-50, 50, (16, 3))
    for _ in range(50):
        points = rng.integers(-40, 40, (20, 3)) // rng.integers(1, 9)
        (listed,) = vectorcodes.shortlists(points.min(0)[None], points.max(0)[None], entries)
        assert listed[vectorcodes.nearest(points, entries)[0]].all()


# ---- the trie ----

def trie_by_hand(rows):
    own = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        own[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [(r, x) for _, r, x in sorted(v)] for c, v in own.items()}
    paths = {}
    for c, turns in own.items():
        h = 0 if c is None else zlib.crc32(str(c).encode()) % 6
        lender = None if c is None else c - (abs(c) % 100) * (1 if c >= 0 else -1)
        paths[c] = turns if c is None else own.get(lender, [])[:h] + turns[h:]
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
        ends[tuple(path)].append(c)
    kids, leaves, saved = collections.Counter(n[:-1] for n in members if n), collections.Counter(), collections.Counter()
    for n, convs in members.items():
        for d in range(len(n) + 1):
            saved[n[:d]] += (len(convs) - 1) * len(n[-1][1]) if n else 0
            leaves[n[:d]] += not kids[n]

    def least(convs):
        return min(convs, key=lambda c: (c is None, c or 0))
    return sorted((str(least(m)), len(n), str(least(members[n[:-1]])) if n else "None", len(m), kids[n], leaves[n], saved[n],
                   hashlib.sha256(",".join(map(str, sorted(c for c in ends[n] if c is not None))).encode()).hexdigest()) for n, m in members.items())


def talk(spark, rows):
    return spark.createDataFrame([(*r, "c", "d", 3) for r in rows], "conv_id bigint, turn bigint, role string, text string, conv string, path string, depth int")


def rebuilt_rows(seed):
    rng = np.random.default_rng(seed)
    rows = []
    for c in [int(x) for x in rng.integers(0, 420, 160)]:
        n = int(rng.integers(1, 9))
        same = rng.integers(0, 3)
        rows += [(c, t, "user" if t % 2 else "assistant", f"text {t if same else int(rng.integers(0, 3))} é" * int(1 + t % 3)) for t in range(n)]
    rows += [(c, t, "user", f"long {t}") for c in (500, 501, 502, 700) for t in range(40 + c % 3)]  # long paths that share openings
    rows += [(801, 0, "user", "only turn"), (None, 2, None, None), (None, None, "user", "x"), (-7, 0, "u", "a"), (-107, 0, "u", "a"), (-107, 0, "u", "a"),
             (900, 0, "", ""), (900, 0, None, None), (900, 1, "a", "z" * 4000)]
    return rows


@pytest.mark.parametrize("stretch,shard", [(64, 4096), (3, 2), (8, 1)])
def test_trie_against_brute_force(spark, stretch, shard):
    rows = rebuilt_rows(stretch)
    got = turntrie.conversation_trie(talk(spark, rows).repartition(5), stretch, shard).collect()
    assert sorted((str(r.conv_id), r.depth, str(r.parent_conv_id), *r[3:]) for r in got) == trie_by_hand(rows)


def test_a_conversation_of_many_turns_and_one_of_all_conversations(spark):
    rows = [(0, t, "user", "ab") for t in range(3000)] + [(c, 0, "user", "same") for c in range(1000, 3000)]
    got = turntrie.conversation_trie(talk(spark, rows), stretch=16, shard=7).collect()
    assert len(got) == len(trie_by_hand(rows[:3000] + rows[3000:3001])) + (len(trie_by_hand(rows[3000:])) - len(trie_by_hand(rows[3000:3001])))
    root = next(r for r in got if r.depth == 0)
    assert root.n_convs == 2001 and root.conv_id == 0 and root.parent_conv_id is None


def test_trie_of_nothing(spark):
    empty = turntrie.conversation_trie(talk(spark, []))
    assert empty.count() == 0 and empty.columns[:3] == ["conv_id", "depth", "parent_conv_id"]
    (root,) = turntrie.conversation_trie(talk(spark, [(801, 0, "user", "x")] if zlib.crc32(b"801") % 6 else [(802, 0, "user", "x")])).filter("depth = 0").collect()
    assert root.n_convs == 1 and root.n_leaves == 1


def test_double_array_holds_exactly_its_sequences():
    rng = np.random.default_rng(3)
    found = sorted({tuple(rng.integers(0, 40, rng.integers(1, 6)).tolist()) for _ in range(500)})
    codes = np.full((len(found), 5), -1, dtype=np.int64)
    for i, s in enumerate(found):
        codes[i, :len(s)] = s
    trie = turntrie.DoubleArray(codes)
    prefixes = {s[:d] for s in found for d in range(1, len(s) + 1)}
    for prefix in itertools.chain(prefixes, itertools.product(range(40), repeat=2)):
        state = 0
        for code in prefix:
            state = int(trie.step(np.array([state]), np.array([code]))[0])
            if state < 0:
                break
        assert (state > 0) == (prefix in prefixes)


# ---- spans ----

def kept_by_hand(rows, window):
    texts = [(t or "").encode().split() for _, t in rows]
    seen = collections.Counter(tuple(w[i:i + window]) for w in texts for i in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(rows, texts):
        gone = np.zeros(len(w), dtype=bool)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = True
        out.append((str(doc_id), len(w), int(gone.sum()), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return sorted(out)


def passages(seed, n, vocabulary):
    rng = np.random.default_rng(seed)
    shared = [" ".join(f"w{x}" for x in rng.integers(0, vocabulary, int(k))) for k in rng.integers(5, 60, 12)]
    rows = []
    for i in range(n):
        parts = [shared[int(rng.integers(12))] if rng.random() < 0.5 else " ".join(f"w{x}" for x in rng.integers(0, vocabulary, int(rng.integers(0, 30))))
                 for _ in range(int(rng.integers(0, 9)))]
        rows.append((i, "\n\t ".join(parts)))
    rows += [(1000, None), (1001, ""), (1002, " \n "), (None, rows[1][1]), (None, "short"), (3, rows[3][1]), (3, rows[3][1]), (4, rows[5][1]),
             (1003, "a " * 400), (1004, " ".join(f"long{i}" for i in range(30000))), (1005, "é x " * 50)]
    return rows


@pytest.mark.parametrize("how,vocabulary", [(spans.Repeats(), 5000), (spans.Repeats(8, 3), 4), (spans.Repeats(3, 1), 40)])
def test_spans_against_brute_force(spark, how, vocabulary):
    rows = passages(how.window, 120, vocabulary)
    table = spark.createDataFrame([(d, t, 1, "k", "w", 5) for d, t in rows], "doc_id bigint, text string, id int, key string, words string, n_words int")
    got = spans.without_repeats(table.repartition(7), how).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.text) for r in got) == kept_by_hand(rows, how.window)
    for r in got:
        assert all(a.at < a.to for a in r.spans) and all(a.to < b.at for a, b in itertools.pairwise(r.spans))


def test_a_passage_in_most_texts_is_dealt_out(spark):
    """An anchor with many different blocks, in several chunks and tasks."""
    rng = np.random.default_rng(9)
    common = " ".join(f"c{i}" for i in range(20))  # shorter than a window: the windows around it all differ
    rows = [(i, " ".join(f"u{x}" for x in rng.integers(0, 10**9, 30)) + f" {common} " + " ".join(f"u{x}" for x in rng.integers(0, 10**9, 30))) for i in range(600)]
    rows += [(1000 + i, rows[i][1] + " tail") for i in range(0, 600, 50)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = spans.without_repeats(table.repartition(4)).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.text) for r in got) == kept_by_hand(rows, 35)
    assert spans.without_repeats(table.limit(0)).count() == 0
