"""Actions, chat, text and search on small frames."""

import pytest
from pyspark.sql import functions as F

from tidewatch.functions import text as X
from tidewatch.operators import actions as A
from tidewatch.operators import conversations as C
from tidewatch.operators import metrics
from tidewatch.operators import returns as R
from tidewatch.operators import search as S
from tidewatch.params import Params

P = Params()


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "t string").select(expr(F.col("t")).alias("r")).first().r


# ---- approvals ----

def _approvals(spark):
    acts = spark.createDataFrame([(1, "pending", "a"), (2, "approved", "b"), (3, "pending", "c")], "action_id int, outcome string, agent_id string")
    asked = spark.createDataFrame([(1, 10, "x"), (1, 11, "y"), (2, 12, "x"), (99, 13, "x")], "action_id int, request_id int, approver string")
    return acts, asked


def test_only_pending_rows_are_approved_and_repeats_count_once(spark):
    acts, asked = _approvals(spark)
    got = {r.action_id: (r.outcome, r.agent_id, r.was_updated) for r in A.approve_actions(acts, asked).collect()}
    assert got == {1: ("approved", "x", True), 2: ("approved", "b", False), 3: ("pending", "c", False)}


def test_report_accounts_for_every_request(spark):
    acts, asked = _approvals(spark)
    got = {r.action_id: (r.result, r.n_requests) for r in A.approval_report(acts, asked).collect()}
    assert got == {1: ("approved", 2), 2: ("not_pending", 1), 99: ("not_found", 1)}


def test_unknown_enums_go_to_quarantine(spark):
    df = spark.createDataFrame([(1, "follow_up_call", "pending", "bill_credit"), (2, "follow_up", None, "loyalty_discount"), (3, "escalation", "retained", None)],
                               "action_id int, action_type string, outcome string, offer_type string")
    got = sorted((r.action_id, r.field, r.value) for r in A.enum_violations(df).collect())
    assert got == [(1, "action_type", "follow_up_call"), (2, "offer_type", "loyalty_discount"), (2, "outcome", None)]


def test_recorded_ids_repeat_on_retry(spark):
    asked = spark.createDataFrame([("s", "bill_credit", "O", "text", 1.0)], "subscriber_id string, offer_type string, offer_id string, drafted_summary string, predicted_retained_clv_usd double")
    rows = [A.record_actions(asked, "lead", F.lit("t")).first() for _ in range(2)]
    assert rows[0].id == rows[1].id and rows[0].audit_trail[0].action == "approved"
    assert A.override_offer(asked, "lead", F.lit("t")).first().status == "overridden"
    pending = A.record_actions(asked, "lead", F.lit("t"), status="pending").first()
    assert pending.decided_at is None


def test_audit_append_starts_from_null(spark):
    df = spark.createDataFrame([(1, None)], "id int, audit_trail array<struct<at:string,by:string,action:string,notes:string,tool:string>>")
    from tidewatch.functions.rules import audit_entry
    entry = audit_entry(*[F.lit(x) for x in ("t", "b", "note", "n", "app")])
    out = A.append_audit(A.append_audit(df, entry), entry).first().audit_trail
    assert [e.action for e in out] == ["note", "note"]


def test_bulk_action_counts_follow_the_written_rows(spark):
    cols = "return_id string, lot_id string, facility string, customer_id int, product_name string, final_tier string, premium_status_labeled string, refund_amount_usd double, status string"
    before = spark.createDataFrame([
        ("r1", "L", "F", 1, "ring", "premium", None, 10.0, "pending"), ("r2", "L", "F", 2, "ring", "premium", "premium", 20.0, "pending"),
        ("r3", "L", "F", 1, "ring", None, None, 30.0, "pending"), ("r4", "L", "F", 2, "ring", "standard", None, 40.0, "pending"),
        ("r5", "M", "F", 2, "ring", "standard", None, 50.0, "pending")], cols)
    now = before.withColumn("status", F.when(F.col("return_id") == "r4", "rejected").otherwise(F.col("status")))
    people = spark.createDataFrame([(1, "Ada Maria Byron"), (2, "Cher")], "customer_id int, customer_name string")
    done = A.bulk_tiered_action(now, people, F.col("lot_id") == "L", "me", F.lit("t"))
    rows = {r.return_id: r for r in done.collect()}
    assert set(rows) == {"r1", "r2", "r3"} and rows["r3"].coupon_pct == 5
    assert rows["r1"].emails[0].body.startswith("Dear Ada Maria Byron, use SAVE20-") and rows["r1"].origin == "premium, hidden"
    attempted = before.filter("lot_id = 'L'")
    s = A.bulk_action_summary(done, attempted).first()
    assert (s.attempted_count, s.approved_count, s.skipped_count) == (4, 3, 1)
    assert (s.premium_email_count, s.premium_labeled_count, s.premium_predicted_hidden_count, s.standard_email_count) == (2, 1, 1, 1)
    assert s.total_refund_usd == 60.0 and [r.return_id for r in A.skipped_rows(done, attempted).collect()] == ["r4"]


# ---- text ----

@pytest.mark.parametrize("query,hits", [
    ("outage credit", {1}), ("outage or refund", {1, 2, 3}), ("outage -credit", {2}), ('"bill credit"', {1}), ('"credit bill"', set()),
    ("the of", set()), ("", set()), ("OUTAGE", {1, 2}), ("-outage refund", {3})])
def test_search_syntax(spark, query, hits):
    df = spark.createDataFrame([(1, "The outage: a bill credit!"), (2, "Outage, again"), (3, "refund paid"), (4, None)], "id int, t string")
    got = df.filter(F.coalesce(X.matches_query(F.col("t"), query), F.lit(False))).collect()
    assert {r.id for r in got} == hits


def test_note_search_ranks_and_ignores_empty_queries(spark):
    df = spark.createDataFrame([(1, "outage outage"), (2, "outage and much other text about nothing"), (3, "fine")], "id int, t string")
    assert [r.id for r in S.note_search(df, "id", "t", "outage").collect()] == [1, 2]
    assert S.note_search(df, "id", "t", "the").count() == 0


@pytest.mark.parametrize("text,out", [
    ("Why is SUB-0000214, at risk?", "SUB-0000214"), ("no id", None), ("xSUB-1 then SUB-2;:", "SUB-2"), ("SUB-1 SUB-2", "SUB-1")])
def test_entity_id(spark, text, out):
    assert one(spark, text, X.entity_id) == out


def test_mojibake(spark):
    good = "café über ñ"
    assert one(spark, good.encode().decode("latin-1"), X.repair_mojibake) == good
    for kept in (good, "plain", "日本", ""):
        assert one(spark, kept, X.repair_mojibake) == kept


@pytest.mark.parametrize("n,out", [(47, "x" * 47), (48, "x" * 48), (49, "x" * 48 + "…")])
def test_title(spark, n, out):
    assert one(spark, "x" * n, lambda c: X.ellipsis(c, 48)) == out


@pytest.mark.parametrize("name,first,last", [("Ada", "Ada", ""), ("  Ada  M  Byron ", "Ada", "M Byron")])
def test_names(spark, name, first, last):
    row = spark.createDataFrame([(name,)], "t string").select(*[c.alias(a) for c, a in zip(X.name_parts(F.col("t")), "fl")]).first()
    assert (row.f, row.l) == (first, last)


@pytest.mark.parametrize("note,label", [
    ("called about outage, still not resolved", "churn_signal"), ("service down twice this month", "churn_signal"),
    ("routine support call, resolved", "healthy"), ("asks about something", "at_risk")])
def test_note_class(spark, note, label):
    assert one(spark, note, X.note_class) == label


def test_classifier_hook_runs_once_per_distinct_note(spark):
    import pandas as pd
    from tidewatch.operators.silver import note_churn_flags

    @F.pandas_udf("string")
    def model(notes: pd.Series) -> pd.Series:
        return notes.map(lambda t: "healthy" if "ok" in t else "churn_signal")

    notes = spark.createDataFrame([("ok",), ("ok",), ("bad",), (None,)], "agent_note_text string")
    got = {r.agent_note_text: r.churn_signal_score for r in note_churn_flags(notes, P, model).collect()}
    assert got == {"ok": 0.1, "bad": 1.0}


# ---- chat ----

def _chat(spark, rows):
    return spark.createDataFrame(rows, "conversation_id int, position int, role string, content string")


def test_history_is_clean_and_ends_with_the_user(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", " "), (2, 0, "user", "a"), (2, 1, "assistant", "b"), (3, 0, "system", "s"), (3, 1, "user", "q"), (4, 0, "user", None)]
    assert sorted((r.conversation_id, r.position) for r in C.sanitize_history(_chat(spark, rows)).collect()) == [(1, 0), (3, 1)]


def test_next_step(spark):
    script = (C.Step("One"), C.Step("Two", ("ready", "done")), C.Step("Three", ("never",)))
    rows = [(1, 0, "user", "hi"), (2, 0, "user", " one "), (2, 1, "assistant", "All DONE"), (3, 0, "user", "one"), (3, 1, "assistant", "wait"),
            (4, 0, "user", "one"), (4, 1, "user", "two"), (4, 2, "assistant", "ready"), (5, 0, "user", "ONE"), (5, 1, "user", "two"), (5, 2, "user", "three")]
    got = {r.conversation_id: r.next_prompt for r in C.next_step(_chat(spark, rows), script).collect()}
    assert got == {1: "One", 2: "Two", 3: None, 4: None, 5: None}


def test_tool_calls(spark):
    ev = spark.createDataFrame([(1, 0, "tool_call", "a", "f", "x", None), (1, 1, "tool_output", "a", None, None, "o1"), (1, 2, "tool_output", "a", None, None, "o2"),
                                (1, 3, "tool_call", "b", "g", "y", None), (1, 4, "tool_output", "zz", None, None, "lost"), (2, 0, "tool_output", "a", None, None, "other")],
                               "conversation_id int, seq int, kind string, call_id string, name string, args string, output string")
    got = {(r.conversation_id, r.name, r.output) for r in C.pair_tool_calls(ev).collect()}
    assert got == {(1, "(unknown)", "lost"), (1, "f", "o2"), (1, "g", None), (2, "(unknown)", "other")}


def test_positions(spark):
    rows = [(1, 0, "user", "a"), (1, 2, "user", "b"), (2, 0, "user", "c"), (2, 0, "user", "d")]
    got = {r.conversation_id: (r.next_position, r.n_duplicates) for r in C.next_positions(_chat(spark, rows)).collect()}
    assert got == {1: (3, 0), 2: (1, 1)}
    flags = {(r.conversation_id, r.position): r.in_sequence for r in C.message_positions(_chat(spark, rows[:2]), P).collect()}
    assert flags == {(1, 0): True, (1, 2): False}


# ---- measures and returns ----

def test_router_uses_the_cube_only_when_it_covers_the_dimensions(lake):
    full = metrics.answer(lake.position, lake.cube, ["risk_band"])
    base = metrics.metric(lake.position, ["risk_band"])
    assert [tuple(map(str, r)) for r in full.orderBy("risk_band").collect()] == [tuple(map(str, r)) for r in base.orderBy("risk_band").collect()]
    assert "service_node_id" in metrics.answer(lake.position, lake.cube, ["service_node_id"]).columns
    with pytest.raises(ValueError):
        metrics.metric(lake.position, ["nope"])


def test_zero_units_and_missing_coordinates(spark):
    lots = spark.createDataFrame([("L1", 1, "F"), ("L2", 1, "F")], "lot_id string, product_id int, facility string")
    products = spark.createDataFrame([(1, "ring")], "product_id int, product_name string")
    items = spark.createDataFrame([("L2", "ASIA", 10.0)], "lot_id string, region string, quantity double")
    back = spark.createDataFrame([("r1", "L1", 5.0), ("r2", "L2", 5.0)], "return_id string, lot_id string, refund_amount_usd double")
    got = {r.lot_id: (r.return_rate_pct, r.region) for r in R.worst_lots(lots, products, items, back).collect()}
    assert got == {"L1": (0.0, None), "L2": (10.0, "ASIA")}
    none = spark.createDataFrame([("x", "y", 1, None, None, None, 1.0)], "city string, country string, customer_id int, customer_lat double, customer_lng double, final_tier string, refund_amount_usd double")
    assert R.city_breakdown(none).count() == 0


def test_blank_filters_and_search_keep_all_rows(lake):
    r = lake["silver_returns"]
    n = r.count()
    assert R.filtered(r, status=None, country=None).count() == n and R.searched(r, "  ", ("city",)).count() == n


def test_action_log_appends(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a")], "id int, v string")
    for _ in range(2):
        A.append_actions(str(tmp_path / "log"), rows)
    assert spark.read.parquet(str(tmp_path / "log")).count() == 2
