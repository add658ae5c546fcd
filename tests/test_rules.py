"""Business rules at their boundaries."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidewatch.functions import rules
from tidewatch.operators import gold
from tidewatch.params import Params

P = Params()

# Ten published rows (monthly bill, risk, CLV at risk, retained by a bill credit).
PUBLISHED = [
    ("124.94", 0.912, 2734.69, 1914.28), ("124.70", 0.911, 2726.44, 1908.51), ("118.15", 0.932, 2642.78, 1849.95),
    ("121.45", 0.898, 2617.49, 1832.24), ("116.33", 0.93, 2596.49, 1817.54), ("122.53", 0.882, 2593.72, 1815.6),
    ("113.19", 0.95, 2580.73, 1806.51), ("113.11", 0.95, 2578.91, 1805.24), ("112.11", 0.95, 2556.11, 1789.28),
    ("115.65", 0.919, 2550.78, 1785.55),
]


def _book(spark, rows):
    return spark.createDataFrame(
        [(s, r, Decimal(a), Decimal(c)) for s, r, a, c in rows],
        "subscriber_id string, churn_reason string, monthly_arpu_usd decimal(9,2), clv_at_risk_usd decimal(12,2)")


def test_published_rows(spark):
    df = spark.createDataFrame([(Decimal(a), r, c, k) for a, r, c, k in PUBLISHED], "arpu decimal(9,2), risk double, clv double, kept double")
    got = df.select(rules.clv_at_risk(F.col("arpu"), F.col("risk"), P).alias("v"), "arpu", "clv", "kept").withColumn(
        "play", rules.offer_plays(F.col("v"), F.col("arpu"), F.lit("service"), P)[0]).collect()
    for row in got:
        assert float(row.v) == row.clv
        assert row.play.offerType == "bill_credit"
        assert float(row.play.predictedRetainedClvUsd) == row.kept


@pytest.mark.parametrize("risk,tickets,band", [
    (0.39, 1, "healthy"), (0.40, 0, "watch"), (0.59, 1, "watch"), (0.60, 0, "elevated"), (0.60, 1, "elevated"),
    (0.75, 0, "elevated"), (0.75, 1, "critical"), (0.95, 1, "critical")])
def test_band_edges(spark, risk, tickets, band):
    row = spark.createDataFrame([(risk, tickets)], "r double, t int").select(
        rules.risk_band(F.col("r"), F.col("t"), P).alias("b"),
        rules.clv_at_risk(F.lit(Decimal("100.00")), F.col("r"), P).alias("c")).first()
    assert row.b == band
    assert (row.c > 0) == (risk >= 0.6)


def test_each_reason_picks_its_offer_when_value_is_high(spark):
    book = _book(spark, [("a", "service", "100", "2000"), ("b", "price", "50", "2000"), ("c", "device", "120", "2500")])
    got = {r.subscriber_id: r.recommended_offer for r in gold.recommendations(book, P).collect()}
    assert got == {"a": "bill_credit", "b": "plan_upgrade_discount", "c": "device_upgrade"}


def test_zero_value_falls_to_the_cheapest_offer_and_is_flagged(spark):
    row = gold.recommendations(_book(spark, [("w", "device", "100", "0")]), P).first()
    assert row.recommended_offer == "bill_credit" and not row.is_profitable
    assert float(row.predicted_net_value_usd) == -40.0


def test_equal_net_keeps_the_fixed_order(spark):
    tied = Params(plan_discount_hit=Decimal("0.7"), plan_discount_miss=Decimal("0.7"), bill_credit_miss=Decimal("0.7"),
                  device_hit=Decimal("0.7"), device_miss=Decimal("0.7"), plan_discount_rate=Decimal("0"),
                  bill_credit_cost=Decimal("0"), device_cost=Decimal("0"))
    ranks = gold.offer_rank(_book(spark, [("t", "price", "100", "1000")]), tied).orderBy("offer_rank").collect()
    assert [r.offer_type for r in ranks] == ["bill_credit", "plan_upgrade_discount", "device_upgrade"]


def test_candidate_prefers_segment_all_then_lowest_id(spark):
    offers = spark.createDataFrame(
        [("O-3", "x", "all", True), ("O-2", "x", "all", False), ("O-1", "x", "vip", True), ("O-4", "x", "all", True)],
        "offer_id string, offer_type string, segment string, is_active boolean")
    assert gold.candidate_offer(offers).first().candidate_offer_id == "O-3"


def test_asof_event_window(spark):
    book = spark.createDataFrame(
        [("in", "N1", "2024-03-31", "service"), ("edge", "N1", "2024-04-09", "service"), ("out", "N1", "2024-04-10", "service"),
         ("future", "N2", "2024-01-01", "service"), ("price", "N1", "2024-03-31", "price")],
        "subscriber_id string, service_node_id string, d string, churn_reason string").withColumn("snapshot_date", F.to_date("d"))
    events = spark.createDataFrame(
        [("E1", "N1", "outage", "2024-03-10"), ("E2", "N1", "degradation", "2024-03-10"), ("E0", "N1", "outage", "2024-02-01"),
         ("E9", "N2", "outage", "2024-01-02")],
        "event_id string, node_id string, event_type string, d string").withColumn("event_date", F.to_date("d"))
    got = {r.subscriber_id: r.linked_event_id for r in gold.asof_event(book, events, P).collect()}
    assert got == {"in": "E2", "edge": "E2", "out": None, "future": None, "price": None}


def test_changed_rows_ignores_first_load(spark):
    cols = "subscriber_id string, risk_band string, churn_risk_score double, clv_at_risk_usd double"
    old = spark.createDataFrame([("a", "watch", 0.5, 0.0), ("b", "watch", 0.5, 0.0), ("gone", "watch", 0.5, 0.0)], cols)
    new = spark.createDataFrame([("a", "watch", 0.5, 0.0), ("b", "elevated", 0.7, 9.0), ("new", "watch", 0.5, 0.0)], cols)
    assert {r.subscriber_id for r in gold.changed_rows(old, new).collect()} == {"b", "gone"}


def test_recommendation_rules_can_fail(spark):
    """One offer for all breaks the mix, more kept than is at risk breaks the totals; each alone."""
    from tidewatch.operators import quality as Q
    position = spark.createDataFrame([("a", 60.0), ("b", 40.0)], "subscriber_id string, clv_at_risk_usd double")

    def verdicts(*rows):
        recs = spark.createDataFrame(list(rows), "recommended_offer string, predicted_retained_clv_usd double")
        return {r.rule: (r.n_bad, r.passed) for r in Q.quality_report([Q.recommendation_rules(recs, position)]).collect()}
    assert verdicts(("x", 30.0), ("y", 20.0)) == {"q14_offer_mix": (0, True), "q14_rollup": (0, True)}
    assert verdicts(("x", 30.0), ("x", 20.0)) == {"q14_offer_mix": (1, False), "q14_rollup": (0, True)}
    assert verdicts(("x", 90.0), ("y", 20.0)) == {"q14_offer_mix": (0, True), "q14_rollup": (1, False)}
