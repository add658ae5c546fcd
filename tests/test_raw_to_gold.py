"""From raw datasets to gold: the validation rules of the specification."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import metrics
from tidewatch.operators import quality as Q
from tidewatch.params import Params
from tidewatch.plans.lake import RawLake
from tidewatch.plans.tables import rebuild
from raw_fixture import AS_OF, FOCUS, NODE, PEOPLE, UNHAPPY, frames
from tidewatch.sources import raw


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("raw"))
    for name, df in frames(spark).items():
        assert raw.write_raw(df, root, name) > 0
    assert set(raw.read_all(spark, root)) == set(raw.RAW_SCHEMAS)
    out = f"{root}/tables"
    lake = RawLake(spark, root, Params(as_of=AS_OF))
    rebuild(lake, out)
    return lake, {n: spark.read.parquet(f"{out}/{n}") for n in (
        "gold_subscriber_position", "gold_open_atrisk", "gold_retention_recommendations", "gold_retention_outcomes", "metric_cube")}


def test_rules_hold(tables):
    lake, t = tables
    position = t["gold_subscriber_position"]
    share = Decimal(UNHAPPY) / PEOPLE
    expected = Q.Expected(clv_per_subscriber=share * Decimal("69.5") * lake.p.clv_months * Decimal("0.8"), tickets_per_subscriber=share)
    red = position.filter(F.col("risk_band").isin("critical", "elevated"))
    report = Q.quality_report([
        Q.position_rules(position, FOCUS, expected), Q.node_rule(position), Q.note_rule(lake["risk_snapshots"]),
        Q.outcome_rule(t["gold_retention_outcomes"]), Q.ramp_rule(lake["risk_snapshots"], red.select("subscriber_id"), lake.p),
        Q.cube_rule(position, t["metric_cube"]),
        Q.key_rule(position, "subscriber_id", "position"), Q.key_rule(lake["tickets"], "ticket_id", "tickets"),
        Q.reference_rule(lake["billing"], lake["subscribers"], "subscriber_id", "billing")])
    failed = {r.rule: r.n_bad for r in report.filter("NOT passed").collect()}
    assert not failed


def test_book_is_the_cohort_and_gets_bill_credits(tables):
    _, t = tables
    position, book, recs = t["gold_subscriber_position"], t["gold_open_atrisk"], t["gold_retention_recommendations"]
    assert position.filter("risk_band = 'critical'").count() == UNHAPPY == book.count()
    assert {r.recommended_offer for r in recs.select("recommended_offer").distinct().collect()} == {"bill_credit"}
    focus = book.filter(F.col("subscriber_id") == FOCUS).first()
    assert focus.candidate_offer_id == "OFFER-001" and focus.linked_event_id == "NET-FAIL"
    assert float(focus.churn_risk_score) == 0.8 and focus.has_recent_dispute
    on_node = metrics.count_by(book, "service_node_id").orderBy(F.desc("subscribers")).first()
    assert on_node.service_node_id == NODE


def test_point_lookup_reaches_every_scan(tables):
    """A filter on the subscriber is pushed through joins and aggregates to the parquet scans."""
    lake, _ = tables
    lake.spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = lake.position.filter(F.col("subscriber_id") == FOCUS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count(f"EqualTo(subscriber_id,{FOCUS})") == 4 and plan.count("FileScan parquet") == 4


def test_measures_read_only_their_columns(tables):
    lake, _ = tables
    plan = metrics.metric(lake.position, ["plan_type"], ("subscriber_count", "clv_at_risk"))._jdf.queryExecution().executedPlan().toString()
    assert "service_summary" not in plan and "note_text" not in plan.replace("agent_note_text", "")


def test_learned_ranking_has_the_heuristic_shape(tables):
    from tidewatch.operators import ml
    lake, t = tables
    fit = ml.train(t["gold_retention_outcomes"], max_iter=3)
    assert ml.train(t["gold_retention_outcomes"].repartition(5), max_iter=3) is fit  # equal rows, one fit
    recs = ml.recommend(fit.model, t["gold_open_atrisk"], lake.p)
    assert recs.columns == t["gold_retention_recommendations"].columns and recs.count() == UNHAPPY
    summary = ml.run_summary(recs, fit).first()
    # A fitting credit keeps more value than it costs: the learned ranking agrees on the cohort's reason.
    assert summary.bill_credit_recommended == UNHAPPY and 0 < summary.rmse < 1500 and summary.beats_mean
    report = Q.recommendation_rules(recs, t["gold_subscriber_position"])
    assert "q14_rollup" in {r.rule for r in report.collect()}
