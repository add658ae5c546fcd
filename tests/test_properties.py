"""Search against brute force in plain Python."""

import math
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewatch.functions import text as X
from tidewatch.operators import search as S

WORDS = ("outage", "credit", "bill", "the", "refund")
texts = st.lists(st.lists(st.sampled_from(WORDS), max_size=8).map(" ".join), min_size=1, max_size=12)
parts = st.one_of(st.sampled_from(WORDS), st.sampled_from(WORDS).map("-{}".format), st.just("or"),
                  st.lists(st.sampled_from(WORDS), min_size=1, max_size=2).map(lambda w: f'"{" ".join(w)}"'))
queries = st.lists(parts, min_size=1, max_size=5).map(" ".join)
quick = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _words(text):
    return [w for w in re.findall("[a-z0-9]+", text.lower()) if w not in X.STOP_WORDS]


def _holds(words, phrase):
    return any(words[i:i + len(phrase)] == phrase for i in range(len(words) - len(phrase) + 1))


def _brute_match(text, query):
    words, groups = _words(text), [[]]
    for part in re.findall(r'-?"[^"]*"|\S+', query):
        if part == "or":
            groups.append([])
        elif _words(part):
            groups[-1].append((part[0] != "-", _words(part)))
    return any(g and all(_holds(words, p) == wanted for wanted, p in g) for g in groups)


@quick
@given(texts, queries)
def test_web_query_against_brute_force(spark, docs, query):
    df = spark.createDataFrame(list(enumerate(docs)), "id int, t string")
    got = {r.id for r in df.filter(X.matches_query(F.col("t"), query)).collect()}
    assert got == {i for i, t in enumerate(docs) if _brute_match(t, query)}


@quick
@given(texts, st.lists(st.sampled_from(WORDS), min_size=1, max_size=3, unique=True))
def test_bm25_against_brute_force(spark, docs, terms):
    query = " or ".join(terms)
    terms = [t for t in terms if t not in X.STOP_WORDS]
    df = spark.createDataFrame(list(enumerate(docs)), "id int, t string")
    got = {r.id: r.score for r in S.bm25_topk(df, "id", "t", query, k=100).collect()}
    bags = [_words(t) for t in docs]
    avg = sum(map(len, bags)) / len(bags)
    want = {}
    for i, bag in enumerate(bags):
        score = 0.0
        for t in terms:
            n = sum(t in b for b in bags)
            tf = bag.count(t)
            score += math.log(1 + (len(bags) - n + 0.5) / (n + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(bag) / avg)) if tf else 0
        if any(t in bag for t in terms):
            want[i] = round(score, 6)
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 2e-6 for i in want)


def test_a_query_of_stop_words_finds_nothing(spark):
    df = spark.createDataFrame([(1, "the bill"), (2, "")], "id int, t string")
    assert S.bm25_topk(df, "id", "t", "the").collect() == S.note_search(df, "id", "t", "the", ["t"]).collect() == []
