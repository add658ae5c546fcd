"""Quality report and learned-ranking queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators import ml
from tidewatch.operators import quality as Q
from tidewatch.params import OFFER_TYPES
from tidewatch.plans.registry import query

_RED = "risk_band IN ('critical', 'elevated')"
_HERO = "SELECT * FROM position_v ORDER BY clv_at_risk_usd DESC, subscriber_id DESC LIMIT 1"
_TREND = """SELECT date_trunc('week', r.snapshot_date) AS period, AVG(churn_risk_score) AS a FROM risk_snapshots r JOIN cohort_v c ON c.subscriber_id = r.subscriber_id
  WHERE snapshot_date > DATE '2024-01-30' - 56 AND snapshot_date <= DATE '2024-01-30' GROUP BY 1"""
_NET = """SELECT churn_reason, offer_type, ROW_NUMBER() OVER (PARTITION BY churn_reason ORDER BY (SUM(retained_clv_usd) - SUM(offer_cost_usd)) / COUNT(*) DESC) AS rn FROM retention_history GROUP BY churn_reason, offer_type"""

_KEYS = {"subscribers": "subscriber_id", "tickets": "ticket_id", "billing": "bill_id", "network_events": "event_id",
         "retention_history": "retention_id", "retention_actions": "action_id", "silver_returns": "return_id"}
_REFS = ("tickets", "billing", "usage", "risk_snapshots", "retention_history")

_ONE = lambda rule, cond, source: f"SELECT '{rule}' AS rule, CASE WHEN {cond} THEN 0 ELSE 1 END AS n_bad FROM {source}"
_N = lambda rule, cond: f"SELECT '{rule}', COUNT(*) FILTER (WHERE {cond}) FROM position_v"

_REPORT = " UNION ALL ".join([
    _ONE("q01_focus_subscriber", "churn_risk_score >= 0.75 AND risk_band = 'critical' AND churn_reason = 'service' AND (has_open_outage OR has_open_billing) AND clv_at_risk_usd > 0", f"({_HERO})"),
    _ONE("q02_focus_offer", "churn_reason = 'service'", f"({_HERO})"),
    _ONE("q03_node_dominates", "MAX(n) * 2 > SUM(n)", f"(SELECT service_node_id, COUNT(*) AS n FROM position_v WHERE {_RED} GROUP BY 1)"),
    _ONE("q04_mostly_healthy", "COUNT(*) FILTER (WHERE risk_band = 'healthy') >= 0.9 * COUNT(*)", "position_v"),
    _ONE("q05_exposure", "CAST(SUM(clv_at_risk_usd) AS DOUBLE) / COUNT(*) BETWEEN 32 AND 48", "position_v"),
    _ONE("q05_tickets", "CAST(SUM(open_ticket_count) AS DOUBLE) / COUNT(*) BETWEEN 0.128 AND 0.192", "position_v"),
    _N("q06_red_signal_low", f"{_RED} AND churn_signal_score < 0.6"), _N("q06_healthy_signal_high", "risk_band = 'healthy' AND churn_signal_score > 0.2"),
    "SELECT 'q07_notes_repeat', CASE WHEN COUNT(DISTINCT agent_note_text) * 10 <= COUNT(agent_note_text) THEN 0 ELSE 1 END FROM risk_snapshots",
    f"SELECT 'q08_offers_learnable', COUNT(*) FILTER (WHERE offer_type <> CASE churn_reason WHEN 'service' THEN 'bill_credit' WHEN 'price' THEN 'plan_upgrade_discount' ELSE 'device_upgrade' END) FROM ({_NET}) WHERE rn = 1",
    _ONE("q09_ramp_in_past", "arg_min(a, period) < arg_max(a, period)", f"({_TREND})"),
    _N("q10_book_not_service", "risk_band <> 'healthy' AND churn_reason <> 'service'"),
    _N("q11_plan_enum", "plan_type NOT IN ('broadband', 'mobile', 'bundle')"), _N("q11_reason_enum", "churn_reason NOT IN ('service', 'price', 'device')"),
    _N("q11_band_enum", "risk_band NOT IN ('critical', 'elevated', 'watch', 'healthy')"), _N("q11_score_range", "churn_risk_score NOT BETWEEN 0 AND 1"),
    _N("q11_geo", "sub_lat NOT BETWEEN -90 AND 90 OR sub_lng NOT BETWEEN -180 AND 180"),
    # The cube's groups, added up again, against the base: 1 where a sum or count differs.
    """SELECT 'q12_cube_equals_base', CASE WHEN c.clv IS NOT DISTINCT FROM b.clv AND c.tickets IS NOT DISTINCT FROM b.tickets AND c.n IS NOT DISTINCT FROM b.n THEN 0 ELSE 1 END
  FROM (SELECT SUM(clv) AS clv, SUM(tickets) AS tickets, SUM(n) AS n FROM (SELECT SUM(clv_at_risk_usd) AS clv, SUM(open_ticket_count) AS tickets, COUNT(*) AS n FROM position_v
    GROUP BY plan_type, churn_reason, risk_band, home_metro)) c CROSS JOIN (SELECT SUM(clv_at_risk_usd) AS clv, SUM(open_ticket_count) AS tickets, COUNT(*) AS n FROM position_v) b""",
    *[f"SELECT 'q13_key_{t}', COUNT(*) FROM (SELECT {k} FROM {t} GROUP BY {k} HAVING COUNT(*) > 1)" for t, k in _KEYS.items()],
    *[f"SELECT 'q13_ref_{t}', COUNT(*) FROM {t} WHERE subscriber_id NOT IN (SELECT subscriber_id FROM subscribers)" for t in _REFS],
    _ONE("q14_offer_mix", "MAX(n) < SUM(n)", "(SELECT recommended_offer, COUNT(*) AS n FROM recs_v GROUP BY 1)"),
    "SELECT 'q14_rollup', CASE WHEN (SELECT SUM(predicted_retained_clv_usd) FROM recs_v) <= (SELECT SUM(clv_at_risk_usd) FROM position_v) THEN 0 ELSE 1 END",
])


@query("quality_report", f"SELECT rule, CAST(n_bad AS BIGINT) AS n_bad, n_bad = 0 AS passed FROM ({_REPORT})")
def _(lake):
    e = Q.Expected()
    lake.pin("position")
    return Q.quality_report([
        Q.position_rules(lake.position, None, e), Q.node_rule(lake.position), Q.note_rule(lake["risk_snapshots"]),
        Q.outcome_rule(lake.outcomes), Q.ramp_rule(lake["risk_snapshots"], lake.cohort, lake.p),
        Q.cube_rule(lake.position, lake.cube), *[Q.key_rule(lake["action_log" if t == "retention_actions" else t], k, t) for t, k in _KEYS.items()],
        *[Q.reference_rule(lake[t], lake["subscribers"], "subscriber_id", t) for t in _REFS],
        Q.recommendation_rules(lake.recs, lake.position)])


@query("duplicate_keys", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST(SUM(n) AS BIGINT) AS n_rows, COUNT(*) FILTER (WHERE n > 1) AS n_duplicate_keys, CAST(COALESCE(SUM(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS n_duplicate_rows FROM (SELECT {k}, COUNT(*) AS n FROM {t} GROUP BY {k})"
    for t, k in {**_KEYS, "lineitem": "l_orderkey", "documents": "md5(text)"}.items()))
def _(lake):
    keys = {**_KEYS, "lineitem": "l_orderkey", "documents": "text"}
    tables = {t: (lake["action_log" if t == "retention_actions" else t], k) for t, k in keys.items()}
    # Texts are compared by a hash, so they are not shuffled.
    tables["documents"] = (lake["documents"].select(F.sha2("text", 256).alias("text")), "text")
    return Q.duplicate_keys(tables)


@query("ml_features", """SELECT retention_id, offer_type, churn_reason, offer_type || '|' || churn_reason AS offer_reason, CAST(monthly_arpu_usd AS DOUBLE) AS monthly_arpu_usd,
  CAST(offer_cost_usd AS DOUBLE) AS offer_cost_usd, CAST(retained_clv_usd AS DOUBLE) AS label FROM retention_history""")
def _(lake):
    return ml.features(lake.outcomes)


# What SQL can say of a learned ranking: whom it covers, and how its numbers hang together.
@query("ml_recommendations", """SELECT subscriber_id, CAST(3 AS INT) AS n_options, true AS offer_is_first, true AS best_net_first, true AS net_is_difference, true AS flag_is_sign,
  CAST(MAX(CASE WHEN offer_type = 'bill_credit' THEN cost_usd END) AS DOUBLE) AS bill_credit_cost_usd, CAST(MAX(CASE WHEN offer_type = 'plan_upgrade_discount' THEN cost_usd END) AS DOUBLE) AS plan_discount_cost_usd,
  CAST(MAX(CASE WHEN offer_type = 'device_upgrade' THEN cost_usd END) AS DOUBLE) AS device_cost_usd FROM plays_v GROUP BY subscriber_id""")
def _(lake):
    recs = ml.recommend(ml.train(lake.outcomes).model, lake.book, lake.p)
    o = F.from_json("offer_ranking", "array<struct<offerType:string,costUsd:decimal(14,2),predictedRetainedClvUsd:decimal(14,2),predictedNetValueUsd:decimal(14,2)>>")
    ranked = recs.withColumn("o", o)

    def cost(offer: str):
        return F.filter("o", lambda x: x["offerType"] == offer)[0]["costUsd"]
    return ranked.select(
        "subscriber_id", F.size("o").alias("n_options"),
        ((F.col("o")[0]["offerType"] == F.col("recommended_offer")) & (F.col("o")[0]["predictedNetValueUsd"] == F.col("predicted_net_value_usd"))).alias("offer_is_first"),
        (F.col("predicted_net_value_usd") == F.array_max(F.transform("o", lambda x: x["predictedNetValueUsd"]))).alias("best_net_first"),
        F.forall("o", lambda x: x["predictedNetValueUsd"] == x["predictedRetainedClvUsd"] - x["costUsd"]).alias("net_is_difference"),
        (F.col("is_profitable") == (F.col("predicted_net_value_usd") > 0)).alias("flag_is_sign"),
        cost("bill_credit").alias("bill_credit_cost_usd"), cost("plan_upgrade_discount").alias("plan_discount_cost_usd"),
        cost("device_upgrade").alias("device_cost_usd"))


@query("ml_summary", "SELECT COUNT(*) AS subscribers_scored, true AS counts_add_up, true AS beats_mean FROM book_v")
def _(lake):
    fit = ml.train(lake.outcomes)
    one = ml.run_summary(ml.recommend(fit.model, lake.book, lake.p), fit)
    counts = sum((F.col(f"{o}_recommended") for o in OFFER_TYPES), F.lit(0))
    return one.select("subscribers_scored", (counts == F.col("subscribers_scored")).alias("counts_add_up"), "beats_mean")


# The fitted numbers, which no SQL gives: error, error of the mean, subscribers and offers.
@query("ml_run_summary")
def _(lake):
    fit = ml.train(lake.outcomes)
    return ml.run_summary(ml.recommend(fit.model, lake.book, lake.p), fit)


# Whether the two rules hold depends on the reasons and values in the book and on the fit, so no SQL says it; tests/test_rules.py breaks each rule.
@query("ml_quality")
def _(lake):
    recs = ml.recommend(ml.train(lake.outcomes).model, lake.book, lake.p)
    return Q.quality_report([Q.recommendation_rules(recs, lake.position)])
