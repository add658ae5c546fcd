"""Split hot keys give the rows of an ordinary window."""

import pytest
from conftest import same_rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewatch.operators.windows import hot_keys, neighbour, running_totals, top_per_key, with_segments
from tidewatch.params import Params


@pytest.fixture(scope="module")
def rows(spark):
    # A third of all rows belongs to one key; positions have gaps.
    i = F.col("id")
    return spark.range(3000).select(
        F.when(i % 3 == 0, F.lit(0)).otherwise(i % 50).alias("k"), (i * 7).alias("seq"), (i % 11).alias("v"))


def test_hot_key_is_split_and_others_are_not(rows):
    seg = with_segments(rows, hot_keys(rows, ["k"], 500), ["k"], "seq", 500)
    per_key = {r.k: r.n for r in seg.groupBy("k").agg(F.countDistinct("segment__").alias("n")).collect()}
    assert per_key[0] > 10 and all(n == 1 for k, n in per_key.items() if k != 0)


@pytest.mark.parametrize("hot_rows", [5, 500, 10**6])
@pytest.mark.parametrize("forward", [True, False])
def test_neighbour(rows, hot_rows, forward):
    w = Window.partitionBy("k").orderBy("seq")
    plain = rows.select("*", (F.lead if forward else F.lag)("v").over(w).alias("n"))
    ours = neighbour(rows, ["k"], "seq", {"n": "v"}, hot_rows, forward)
    same_rows(ours, plain)


@pytest.mark.parametrize("hot_rows", [5, 500, 10**6])
def test_running_totals(rows, hot_rows):
    w = Window.partitionBy("k").orderBy("seq")
    plain = rows.select("*", F.sum("v").over(w).alias("t"))
    ours = running_totals(rows, ["k"], "seq", {"t": "v"}, hot_rows)
    same_rows(ours, plain)


def test_top_per_key_limits_before_the_shuffle(rows):
    top = top_per_key(rows, ["k"], [F.desc("v"), F.asc("seq")], 3)
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()
    assert top.groupBy("k").count().filter("count > 3").isEmpty()


def test_queries_agree_when_every_key_is_hot(lake):
    """The split path over real tables gives the rows of the plain path."""
    from tidewatch.operators import actions, conversations, history
    split = Params(hot_key_rows=3)
    for fn in (lambda p: history.scd2(lake["change_feed"], p),
               lambda p: conversations.message_positions(lake["messages"], p),
               lambda p: actions.spend_cap(lake["model_calls"], F.lit(0.01), p)):
        a, b = fn(Params()), fn(split)
        same_rows(a, b)
