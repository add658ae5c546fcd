"""Streams give the rows of their batch twins, also after replays and late rows."""

import pytest
from conftest import same_rows
from pyspark.sql import functions as F

from tidewatch.operators import history
from tidewatch.params import Params
from tidewatch.streaming import batches, cdc, chains, kpi

P = Params()


@pytest.fixture
def feed_dir(lake, tmp_path):
    """The change feed as files that arrive out of order, with redelivered rows."""
    feed = lake["change_feed"].select(*cdc._COLS).filter("entity_key < 12")
    root = str(tmp_path / "feed")
    for n, part in enumerate((1, 0, 3, 2)):
        rows = feed.filter(F.floor(F.col("lsn") / 300) % 4 == part)
        again = feed.filter((F.col("lsn") % 50 == 0) & (F.floor(F.col("lsn") / 300) % 4 < 2))
        rows.unionByName(again).coalesce(1).write.mode("append").parquet(f"{root}/n={n}")
    return feed, root


def _run(spark, root, out, p=P, buckets=64):
    stream = batches.file_stream(spark, f"{root}/n=*", cdc.FEED, 1)
    cdc.stream_history(stream, f"{out}/h", f"{out}/cp", p, buckets)


@pytest.mark.parametrize("hot_rows,buckets", [(4, 3), (10**6, 64)])
def test_history_equals_batch(spark, feed_dir, tmp_path, hot_rows, buckets):
    feed, root = feed_dir
    p = Params(hot_key_rows=hot_rows)
    _run(spark, root, str(tmp_path), p, buckets)
    assert len(batches.finished(spark, f"{tmp_path}/h/versions")) == 4
    same_rows(cdc.read_history(spark, f"{tmp_path}/h", p), history.scd2(feed, P))
    same_rows(cdc.read_latest(spark, f"{tmp_path}/h"), history.latest_state(feed))


def test_replayed_batch_changes_nothing(spark, feed_dir, tmp_path):
    feed, root = feed_dir
    _run(spark, root, str(tmp_path))
    before = cdc.read_history(spark, f"{tmp_path}/h", P).collect()
    done = batches.finished(spark, f"{tmp_path}/h/versions")
    writer = cdc.HistoryWriter(f"{tmp_path}/h", P)
    writer(spark.read.schema(cdc.FEED).parquet(f"{root}/n=3"), done[-1])
    again = cdc.read_history(spark, f"{tmp_path}/h", P).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, before))
    _run(spark, root, str(tmp_path))  # nothing new: the checkpoint is complete
    assert batches.finished(spark, f"{tmp_path}/h/versions") == done


def _changes(spark, *kl):
    rows = spark.createDataFrame([(k, n, "s", "upsert") for k, n in kl], "entity_key bigint, lsn bigint, state string, change_type string")
    return rows.withColumn("changed_at", F.timestamp_seconds(F.col("lsn")).cast("timestamp_ntz"))


def test_a_batch_writes_its_own_keys_only(spark, tmp_path):
    writer = cdc.HistoryWriter(f"{tmp_path}/h", P, buckets=4, compact_every=5)
    writer(_changes(spark, *[(k, k) for k in range(100)]), 0)
    for n in range(1, 12):
        writer(_changes(spark, (n % 3, 1000 + n), (200 + n, n)), n)
        stored = batches.get(spark, f"{tmp_path}/h/versions", cdc.STORED, [n])
        assert stored.filter("lsn >= 1000 OR entity_key > 150").count() == stored.filter("valid_to IS NULL").count() + (n > 3)
        assert stored.filter("valid_to IS NULL").count() == 2
    assert batches.finished(spark, f"{tmp_path}/h/base") == [4, 9]
    assert cdc.read_latest(spark, f"{tmp_path}/h").count() == 111
    h = cdc.read_history(spark, f"{tmp_path}/h", P)
    assert h.count() == 100 + 22 and h.filter("is_current").count() == 111


def test_a_base_with_every_batch(spark, tmp_path):
    writer, feed = cdc.HistoryWriter(f"{tmp_path}/h", P, buckets=2, compact_every=1, fanout=2), []
    for n in (0, 1, 2, 2):
        feed += [(1, n), (2 + n, n)]
        writer(_changes(spark, (1, n), (2 + n, n)), n)
    same_rows(cdc.read_history(spark, f"{tmp_path}/h", P), history.scd2(_changes(spark, *feed), P))


def test_closed_versions_are_merged_by_size(spark, tmp_path):
    """Eight small batches with late rows: few folders to list, the rows of the batch job, also when the newest batch runs again."""
    writer = cdc.HistoryWriter(f"{tmp_path}/h", P, buckets=2, compact_every=2, fanout=2)
    feed = []
    for n in range(8):
        rows = [(n % 3, 100 * n + 50), (n % 5, 100 * n + 60), (7, 40 if n == 5 else 100 * n + 70)]
        feed += rows
        writer(_changes(spark, *rows), n)
        if n in (0, 7):
            same_rows(cdc.read_history(spark, f"{tmp_path}/h", P), history.scd2(_changes(spark, *feed), P))
    _, parts, to = cdc._segments(spark, f"{tmp_path}/h")
    assert to == 7 and sorted(p["tier"] for p in parts) == [2]
    assert batches.finished(spark, f"{tmp_path}/h/versions") == [5, 6, 7] and batches.finished(spark, f"{tmp_path}/h/base") == [5, 7]
    assert len([f for f in (tmp_path / "h" / "merged").iterdir() if f.is_dir()]) <= 4
    writer(_changes(spark, *feed[-3:]), 7)
    same_rows(cdc.read_history(spark, f"{tmp_path}/h", P), history.scd2(_changes(spark, *feed), P))
    writer(_changes(spark, (1, 5000)), 8)
    same_rows(cdc.read_history(spark, f"{tmp_path}/h", P), history.scd2(_changes(spark, *feed, (1, 5000)), P))


def test_unfinished_batch_is_not_read(spark, tmp_path):
    df = spark.range(3)
    batches.put(df, f"{tmp_path}/t", 0)
    batches.put(df, f"{tmp_path}/t", 1)
    (tmp_path / "t" / "batch=1" / "_SUCCESS").rename(tmp_path / "t" / "batch=1" / "_open")
    assert batches.get(spark, f"{tmp_path}/t", "id bigint").count() == 3


def test_intervals_are_contiguous(lake):
    h = history.scd2(lake["change_feed"], P)
    assert h.filter("is_current").groupBy("entity_key").count().filter("count > 1").isEmpty()
    assert h.filter("valid_to < valid_from").isEmpty()


def test_delete_closes_and_opens_nothing(spark):
    rows = spark.createDataFrame([(1, 1, "a", "upsert"), (1, 2, "b", "upsert"), (1, 2, "b", "upsert"), (1, 3, None, "delete"), (2, 5, "z", "upsert")],
                                 "entity_key bigint, lsn bigint, state string, change_type string").withColumn(
        "changed_at", F.timestamp_seconds(F.col("lsn")).cast("timestamp_ntz"))
    got = {(r.entity_key, r.lsn): r.is_current for r in history.scd2(rows, P).collect()}
    assert got == {(1, 1): False, (1, 2): False, (2, 5): True}
    assert [r.entity_key for r in history.latest_state(rows).collect()] == [2]


def test_chains_over_several_batches(spark, lake, tmp_path):
    log = lake["workflow_state"].select("event_id", "subscriber_id", "action_date", "created_at", "event_type")
    for n in range(3):
        log.filter(F.col("event_id") % 3 == n).coalesce(1).write.parquet(f"{tmp_path}/log/n={n}")
    stream = batches.file_stream(spark, f"{tmp_path}/log/n=*", chains.LOG, 1)
    chains.stream_chains(stream, f"{tmp_path}/c", f"{tmp_path}/cp")
    assert len(batches.finished(spark, f"{tmp_path}/c/chains")) >= 3
    want = history.decision_chains(log)
    same_rows(chains.read_chains(spark, f"{tmp_path}/c").select(*want.columns), want)


def test_chains_with_expiry_keep_recent_chains(spark, lake, tmp_path):
    log = lake["workflow_state"].select("event_id", "subscriber_id", "action_date", "created_at", "event_type")
    log.coalesce(1).write.parquet(f"{tmp_path}/log")
    chains.stream_chains(batches.file_stream(spark, f"{tmp_path}/log", chains.LOG), f"{tmp_path}/c", f"{tmp_path}/cp", keep_days=2)
    want = history.decision_chains(log)
    same_rows(chains.read_chains(spark, f"{tmp_path}/c").select(*want.columns), want)


@pytest.mark.parametrize("events,verdict,missing", [
    ([("risk_trigger", 1), ("offer_recommended", 2), ("action_submitted", 3), ("action_approved", 4)], "complete", ""),
    ([("risk_trigger", 1), ("offer_recommended", 2), ("action_submitted", 3)], "incomplete", "action_approved"),
    ([("risk_trigger", 1), ("offer_recommended", 3), ("action_submitted", 2), ("action_approved", 4)], "out_of_order", "")])
def test_chain_verdicts(spark, events, verdict, missing):
    log = spark.createDataFrame([(i, "s", "2026-08-28", t) for t, i in events],
                                "event_id bigint, subscriber_id string, action_date string, event_type string")
    row = history.decision_chains(log).first()
    assert (row.verdict, row.missing_steps) == (verdict, missing)


def test_kpi_over_several_batches(spark, lake, tmp_path):
    from tidewatch.operators.actions import live_kpi
    acts = lake["retention_actions"].select("action_id", "subscriber_id", "outcome", "created_at")
    for n in range(3):
        acts.filter(F.col("action_id") % 3 == n).coalesce(1).write.parquet(f"{tmp_path}/a/n={n}")
    kpi.stream_kpi(batches.file_stream(spark, f"{tmp_path}/a/n=*", kpi.ACTIONS, 1), f"{tmp_path}/k", f"{tmp_path}/cp")
    same_rows(kpi.read_kpi(spark, f"{tmp_path}/k", lake.position), live_kpi(lake.position, acts))
