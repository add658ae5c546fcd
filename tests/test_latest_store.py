"""The store of latest rows against a pass over the history, and what it reads for it."""

import random
from datetime import date, timedelta

import pytest
from conftest import same_rows
from pyspark.sql import functions as F

from tidewatch.operators import gold
from tidewatch.operators.latest_store import LatestStore
from tidewatch.params import Params

SCHEMA = "subscriber_id string, snapshot_date date, churn_risk_score double, churn_reason string, agent_note_text string"
FIRST = date(2023, 1, 1)


def day(n):
    return FIRST + timedelta(days=n)


def snapshots(spark, seen):
    """One row for each (subscriber, day number)."""
    return spark.createDataFrame([(f"s{k}", day(n), n / 400, "price", f"note {k % 7} {n}") for k, n in seen], SCHEMA)


def wanted(df, at):
    return gold.current_snapshot(df, Params(as_of=at))


@pytest.fixture(scope="module")
def long_history(spark, tmp_path_factory):
    """400 days; a few subscribers were last seen on the first day, some in the middle, most are seen daily."""
    rng = random.Random(7)
    seen = [(k, 0) for k in range(5)] + [(k, n) for k in range(5, 15) for n in range(0, 36 * (k - 4), 9)]
    seen += [(k, n) for k in range(15, 30) for n in [*range(0, 380, 9), *range(380, 400)]] + [(k, 9 * rng.randrange(44)) for k in range(30, 60)]
    df = snapshots(spark, seen)
    store = LatestStore(spark, str(tmp_path_factory.mktemp("latest")), df.schema, "subscriber_id", "snapshot_date", buckets=2)
    store.add(df.filter(F.col("snapshot_date") < F.lit(day(390))), "old")
    store.add(df.filter(F.col("snapshot_date") >= F.lit(day(390))), "new")
    return store, df


@pytest.mark.parametrize("n", [0, 63, 200, 399, 1000])
def test_any_day_equals_the_pass(long_history, n):
    store, df = long_history
    got = store.at(day(n))
    same_rows(got.rows, wanted(df, day(n)))
    assert len(got.read) <= 8 * 4
    # Day windows end with the asked day; nothing later is read.
    last = day(min(n, 399)).toordinal() - date(1970, 1, 1).toordinal()
    assert all((w + 1) * 8 ** level <= last + 1 for level, w in got.read)


def test_before_the_first_day_nothing_is_known(long_history):
    store, df = long_history
    got = store.at(day(-1))
    assert got.rows.isEmpty() and got.rows.schema == df.schema


def test_old_windows_are_not_read_when_nothing_is_missing(spark, tmp_path):
    df = snapshots(spark, [(k, n) for k in range(20) for n in range(70, 100)])
    store = LatestStore(spark, str(tmp_path), df.schema, "subscriber_id", "snapshot_date", buckets=4)
    store.add(df)
    got = store.at(day(99))
    same_rows(got.rows, wanted(df, day(99)))
    assert {level for level, _ in got.read} <= {0} and len(got.read) <= 8
    # The level before is read for a subscriber who left, in that subscriber's bucket.
    store.add(snapshots(spark, [(99, 75)]))
    got = store.at(day(99))
    assert got.rows.count() == 21 and 0 < len([1 for level, _ in got.read if level]) <= 8


def test_late_rows_rebuild_their_windows(spark, tmp_path):
    rng = random.Random(3)
    seen = [(rng.randrange(40), rng.randrange(27)) for _ in range(200)]
    store = LatestStore(spark, str(tmp_path), snapshots(spark, []).schema, "subscriber_id", "snapshot_date", width=3, buckets=2)
    for part in range(3):
        store.add(snapshots(spark, set(seen[part::3])), f"b{part}")
    df = snapshots(spark, set(seen))
    for n in (5, 13, 26):
        same_rows(store.at(day(n)).rows, wanted(df, day(n)))
    before = set(store.manifest.folders())
    store.vacuum()
    assert set(store.manifest.folders()) < before
    same_rows(store.at(day(20)).rows, wanted(df, day(20)))


def test_repeated_batches_nulls_and_ties(spark, tmp_path):
    schema = snapshots(spark, []).schema
    store = LatestStore(spark, str(tmp_path), schema, "subscriber_id", "snapshot_date")
    assert store.at(day(0)).rows.isEmpty()
    store.add(spark.createDataFrame([], schema), "none")
    assert store.at(day(0)).rows.isEmpty()
    rows = spark.createDataFrame([("a", day(1), 0.5, None, None), ("a", day(1), 0.7, "price", "x"), ("a", None, 1.0, None, None), (None, day(2), 1.0, None, None)], schema)
    store.add(rows, "one")
    version = store.manifest.version()
    store.add(rows, "one")
    assert store.manifest.version() == version
    assert [tuple(r) for r in store.at(day(5)).rows.collect()] == [("a", day(1), 0.7, "price", "x")]
    with pytest.raises(ValueError):
        LatestStore(spark, str(tmp_path), schema, "subscriber_id", "snapshot_date", width=1)
