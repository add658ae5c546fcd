"""What the physical plans must not contain, and what the scans must prune."""

import re

import pytest

from tidewatch.plans import catalog
from tidewatch.plans.lake import Lake

# These run jobs while they are planned; their plans start from written rows.
EAGER = {n for n in catalog.QUERIES if n.endswith("_stream")} | {"ml_recommendations", "ml_summary", "ml_run_summary", "ml_quality", "quality_report"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - EAGER))
def test_no_cross_product_and_no_python(name, spark, sf_dir):
    plan = _plan(catalog.runner(name)(spark, sf_dir))
    assert "CartesianProduct" not in plan
    assert not re.search("EvalPython|InPandas|InArrow|PythonUDF", plan)
    assert "NestedLoopJoin" not in plan


@pytest.mark.parametrize("name,table,columns", [
    ("returns_by_product", "lineitem", {"l_orderkey", "l_partkey", "l_extendedprice", "l_discount", "l_returnflag"}),
    ("silver_tickets", "events", {"event_id", "ts", "user_id", "event_type"}),
    ("note_dedup_ratio", "events", {"event_id", "ts", "user_id", "event_type"}),
    ("usage_daily", "orders", {"o_orderkey", "o_custkey"}),
    ("offer_mix", "orders", None), ("anger_score", "documents", {"doc_id", "text"})])
def test_scans_read_only_needed_columns(name, table, columns, spark, sf_dir):
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = _plan(catalog.runner(name)(spark, sf_dir))
    read = [set(re.findall(r"(\w+):", m.group(1))) for m in re.finditer(rf"{table}\.parquet.*?ReadSchema: struct<(.*?)>\n", plan + "\n")]
    # The offer mix needs no billing data, so its scan is gone or reads no column but the keys.
    assert read or columns is None
    assert all(r <= (columns or {"o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority"}) for r in read)


def test_filters_reach_the_scan(spark, sf_dir):
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    assert "EqualTo(l_returnflag,R)" in _plan(catalog.runner("status_summary")(spark, sf_dir))


def test_newest_actions_are_cut_before_their_notes_are_read(spark, sf_dir):
    plan = _plan(catalog.runner("recent_actions")(spark, sf_dir))
    assert plan.index("Join") < plan.index("TakeOrdered", plan.index("Join")) and "documents.parquet" in plan


def test_unlimited_queues_come_in_their_order(spark, sf_dir):
    rows = catalog.runner("queue_sort_value")(spark, sf_dir).collect()
    assert rows == sorted(rows, key=lambda r: (-r.refund_amount_usd, r.return_id)) and len(rows) > 100
    care = catalog.runner("care_queue_by_tenure")(spark, sf_dir).collect()
    assert [r.subscriber_id for r in care] == [r.subscriber_id for r in sorted(care, key=lambda r: (-r.tenure_months, r.subscriber_id))]


def test_timeline_reaches_every_facility(spark, sf_dir):
    lake = Lake(spark, sf_dir)
    seen = catalog.runner("entity_timeline")(spark, sf_dir).select("return_id").distinct()
    pending = lake["silver_returns"].filter("status = 'pending'")
    assert pending.join(seen, "return_id").select("facility").distinct().count() == pending.select("facility").distinct().count()


def test_a_note_on_most_rows_is_dealt_out(spark):
    """With broadcasts off, snapshots are not exchanged on the note alone."""
    from tidewatch.operators.silver import with_note_score
    from tidewatch.params import Params
    rows = spark.range(2000).selectExpr("concat('s', id) AS subscriber_id", "DATE '2024-01-30' AS snapshot_date",
                                        "CASE WHEN id % 10 > 0 THEN 'same' WHEN id % 20 = 0 THEN 'rare' END AS agent_note_text")
    flags = spark.createDataFrame([("same", 0.6), ("rare", 0.1)], "agent_note_text string, churn_signal_score double")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        scored = with_note_score(rows, Params(), flags)
        assert not re.search(r"hashpartitioning\(agent_note_text#\d+, \d+\)", _plan(scored))
        counts = {r.churn_signal_score: r["count"] for r in scored.groupBy("churn_signal_score").count().collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert counts == {0.6: 1800, 0.1: 100, None: 100}


def test_recent_weeks_bound_the_events(spark, sf_dir):
    """The window behind the snapshots reads the last weeks only; who ever had an event is read from all, by one column."""
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = _plan(Lake(spark, sf_dir).recent_snapshots(56))
    assert "GreaterThanOrEqual(ts,2023-11-30T00:00)" in plan


def test_lookup_of_one_subscriber_reaches_the_scans(spark, sf_dir):
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = _plan(catalog.runner("subscriber_detail")(spark, sf_dir))
    assert "EqualTo(c_custkey,42)" in plan and "EqualTo(user_id,42)" in plan
    plan = _plan(catalog.runner("return_detail")(spark, sf_dir))
    assert "EqualTo(l_orderkey," in plan
