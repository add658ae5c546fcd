"""Queries of the retention domain: silver, gold, measures and ranked views."""

from __future__ import annotations

import uuid
from dataclasses import replace
from datetime import date, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from tidewatch.functions import rules
from tidewatch.operators import gold, metrics, silver
from tidewatch.operators.cube_store import CubeStore, changed_rows
from tidewatch.operators.latest_store import LatestStore
from tidewatch.params import BANDS
from tidewatch.plans.registry import query
from tidewatch.session import cut_lineage, shared_dir

RED = ("critical", "elevated")


# ---- silver ----

@query("note_churn_flags", "SELECT agent_note_text, note_class, churn_signal_score FROM note_churn_flags_v")
def _(lake):
    return lake.flags


@query("silver_tickets", "SELECT * FROM silver_tickets_v")
def _(lake):
    return lake.tickets_rollup


@query("silver_risk", """SELECT subscriber_id, snapshot_date, churn_risk_score, churn_reason, agent_note_text, plan_type, tenure_months,
  CAST(monthly_arpu_usd AS DOUBLE) AS monthly_arpu_usd, service_node_id, home_metro, churn_signal_score FROM silver_risk_v""")
def _(lake):
    return lake.silver_risk.drop("open_ticket_count")


@query("silver_billing", "SELECT * FROM silver_billing_v")
def _(lake):
    return lake.billing_rollup


@query("silver_retention", """SELECT h.retention_id, h.subscriber_id, h.offer_type, h.churn_reason, CAST(h.monthly_arpu_usd AS DOUBLE) AS monthly_arpu_usd, h.initiated_date,
  CAST(h.offer_cost_usd AS DOUBLE) AS offer_cost_usd, h.retained, CAST(h.retained_clv_usd AS DOUBLE) AS retained_clv_usd, s.plan_type, s.tenure_months, s.home_metro
  FROM retention_history h LEFT JOIN subscribers s ON h.subscriber_id = s.subscriber_id""")
def _(lake):
    return silver.silver_retention(lake["retention_history"], lake["subscribers"])


@query("usage_daily", """SELECT subscriber_id, usage_date, CAST(SUM(data_gb) AS DOUBLE) AS data_gb, CAST(SUM(voice_min) AS BIGINT) AS voice_min,
  CAST(SUM(stream_hours) AS DOUBLE) AS stream_hours, COUNT(*) AS n_rows FROM usage GROUP BY subscriber_id, usage_date""")
def _(lake):
    return silver.usage_daily(lake["usage"])


@query("usage_sparkline", """SELECT subscriber_id, string_agg(CAST(usage_date AS VARCHAR) || '=' || CAST(data_gb AS VARCHAR), ',' ORDER BY usage_date) AS series, COUNT(*) AS n_days
  FROM (SELECT subscriber_id, usage_date, SUM(data_gb) AS data_gb FROM usage WHERE usage_date > DATE '2024-01-30' - 30 AND usage_date <= DATE '2024-01-30' GROUP BY subscriber_id, usage_date)
  GROUP BY subscriber_id""")
def _(lake):
    line = silver.usage_sparkline(silver.usage_daily(lake["usage"]), lake.p)
    text = F.transform("series", lambda s: F.concat(s["usage_date"].cast("string"), F.lit("="), s["data_gb"].cast("string")))
    return line.select("subscriber_id", F.array_join(text, ",").alias("series"),
                       F.size("series").cast("bigint").alias("n_days"))


# ---- gold ----

_CURRENT = """SELECT subscriber_id, snapshot_date, churn_risk_score, churn_reason, agent_note_text FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY subscriber_id ORDER BY snapshot_date DESC) AS rn FROM risk_snapshots WHERE snapshot_date <= DATE '2024-01-30') WHERE rn = 1"""


@query("current_snapshot", _CURRENT)
def _(lake):
    return gold.current_snapshot(lake["risk_snapshots"], lake.p)


@query("current_snapshot_stored", _CURRENT)
def _(lake):
    """From the store of latest rows, to which the last week came as a second batch."""
    columns = ("subscriber_id", *gold.SNAPSHOT_COLS)
    snapshots = lake["risk_snapshots"].select(*columns)
    store = LatestStore(lake.spark, f"{shared_dir(lake.spark)}/latest-{uuid.uuid4().hex}", snapshots.schema, "subscriber_id", "snapshot_date", buckets=4)
    last_week = F.col("snapshot_date") > F.lit(lake.p.as_of - timedelta(days=7))
    store.add(snapshots.filter(~last_week), "before")
    store.add(snapshots.filter(last_week), "last week")
    return store.at(lake.p.as_of).rows


@query("subscriber_position", "SELECT * REPLACE (CAST(monthly_arpu_usd AS DOUBLE) AS monthly_arpu_usd, CAST(clv_at_risk_usd AS DOUBLE) AS clv_at_risk_usd) FROM position_v")
def _(lake):
    return lake.position


@query("risk_band", "SELECT subscriber_id, churn_risk_score, open_ticket_count, risk_band FROM position_v")
def _(lake):
    return lake.position.select("subscriber_id", "churn_risk_score", "open_ticket_count", "risk_band")


@query("clv_at_risk", "SELECT subscriber_id, CAST(monthly_arpu_usd AS DOUBLE) AS monthly_arpu_usd, churn_risk_score, CAST(clv_at_risk_usd AS DOUBLE) AS clv_at_risk_usd FROM position_v")
def _(lake):
    return lake.position.select("subscriber_id", "monthly_arpu_usd", "churn_risk_score", "clv_at_risk_usd")


@query("open_atrisk", """SELECT subscriber_id, plan_type, home_metro, sub_lat, sub_lng, risk_band, churn_risk_score, CAST(clv_at_risk_usd AS DOUBLE) AS clv_at_risk_usd, churn_reason,
  has_open_outage, has_open_billing, CAST(monthly_arpu_usd AS DOUBLE) AS monthly_arpu_usd, linked_event_id, linked_event_type, linked_event_date, candidate_offer_id FROM open_atrisk_v""")
def _(lake):
    return lake.pin("book").open_atrisk.select(
        "subscriber_id", "plan_type", "home_metro", "sub_lat", "sub_lng", "risk_band", "churn_risk_score",
        "clv_at_risk_usd", "churn_reason", "has_open_outage", "has_open_billing", "monthly_arpu_usd",
        "linked_event_id", "linked_event_type", "linked_event_date", "candidate_offer_id")


@query("asof_network_event", "SELECT subscriber_id, service_node_id, snapshot_date, churn_reason, linked_event_id, linked_event_type, linked_event_date FROM open_atrisk_v")
def _(lake):
    return gold.asof_event(lake.pin("book").book, lake["network_events"], lake.p).select(
        "subscriber_id", "service_node_id", "snapshot_date", "churn_reason",
        "linked_event_id", "linked_event_type", "linked_event_date")


@query("candidate_offer", """SELECT h.offer_type, h.churn_reason, COUNT(*) AS n_asked, c.candidate_offer_id
  FROM (SELECT churn_reason, CASE churn_reason WHEN 'service' THEN 'bill_credit' WHEN 'price' THEN 'plan_upgrade_discount' ELSE 'device_upgrade' END AS offer_type FROM position_v) h
  LEFT JOIN (SELECT offer_type, offer_id AS candidate_offer_id FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY offer_type ORDER BY CASE WHEN segment = 'all' THEN 0 ELSE 1 END, offer_id) AS rn FROM offers WHERE is_active) WHERE rn = 1) c
  ON c.offer_type = h.offer_type GROUP BY h.offer_type, h.churn_reason, c.candidate_offer_id""")
def _(lake):
    asked = (lake.position.select("churn_reason", rules.offer_for_reason(F.col("churn_reason")).alias("offer_type"))
             .groupBy("offer_type", "churn_reason").agg(F.count(F.lit(1)).alias("n_asked")))
    return asked.join(gold.candidate_offer(lake["offers"]), "offer_type", "left")


@query("offer_catalog", """SELECT o.offer_id, o.offer_name, o.offer_type, o.value_usd, CASE WHEN o.offer_type = 'plan_upgrade_discount' THEN 'fraction' ELSE 'usd' END AS value_unit,
  o.segment, o.is_active, COALESCE(h.times_offered, 0) AS times_offered, COALESCE(h.times_retained, 0) AS times_retained
  FROM offers o LEFT JOIN (SELECT offer_type, COUNT(*) AS times_offered, CAST(SUM(CASE WHEN retained THEN 1 ELSE 0 END) AS BIGINT) AS times_retained FROM retention_history GROUP BY offer_type) h ON o.offer_type = h.offer_type""")
def _(lake):
    used = lake["retention_history"].groupBy("offer_type").agg(
        F.count(F.lit(1)).alias("times_offered"), F.count_if("retained").alias("times_retained"))
    return (lake["offers"].join(used, "offer_type", "left")
            .select("offer_id", "offer_name", "offer_type", "value_usd",
                    rules.value_unit(F.col("offer_type")).alias("value_unit"), "segment", "is_active",
                    F.coalesce("times_offered", F.lit(0)).alias("times_offered"),
                    F.coalesce("times_retained", F.lit(0)).alias("times_retained")))


@query("retention_recommendations", """SELECT subscriber_id, recommended_offer, CAST(predicted_retained_clv_usd AS DOUBLE) AS predicted_retained_clv_usd,
  CAST(predicted_net_value_usd AS DOUBLE) AS predicted_net_value_usd, predicted_net_value_usd > 0 AS is_profitable, offer_ranking, DATE '2024-01-30' AS scored_on FROM recs_v""")
def _(lake):
    return lake.recs


@query("offer_ranking", "SELECT subscriber_id, offer_ranking FROM recs_v")
def _(lake):
    return lake.recs.select("subscriber_id", "offer_ranking")


@query("offer_rank", """SELECT subscriber_id, offer_rank, offer_type, CAST(cost_usd AS DOUBLE) AS cost_usd, CAST(retained_clv_usd AS DOUBLE) AS retained_clv_usd,
  CAST(net_value_usd AS DOUBLE) AS net_value_usd FROM plays_v""")
def _(lake):
    return gold.offer_rank(lake.book, lake.p)


@query("offer_what_if", """SELECT b.subscriber_id, 'plan_upgrade_discount' AS what_if_offer, r.recommended_offer, CAST(CAST(b.clv_at_risk_usd * 0.80 AS DECIMAL(12,2)) AS DOUBLE) AS what_if_retained_usd,
  CAST(CAST(b.clv_at_risk_usd * 0.80 AS DECIMAL(12,2)) - 138 AS DOUBLE) AS what_if_net_usd,
  CAST(CAST(b.clv_at_risk_usd * 0.80 AS DECIMAL(12,2)) - 138 - r.predicted_net_value_usd AS DOUBLE) AS delta_net_usd,
  CAST(b.clv_at_risk_usd * 0.80 AS DECIMAL(12,2)) - 138 > r.predicted_net_value_usd AS beats_recommended
  FROM book_v b JOIN recs_v r ON b.subscriber_id = r.subscriber_id""")
def _(lake):
    return gold.offer_what_if(lake.book, lake.p, offer_type="plan_upgrade_discount",
                              hit=Decimal("0.80"), cost=Decimal("138"))


@query("retention_outcomes", """SELECT retention_id, subscriber_id, offer_type, churn_reason, CAST(monthly_arpu_usd AS DOUBLE) AS monthly_arpu_usd, CAST(offer_cost_usd AS DOUBLE) AS offer_cost_usd,
  retained, CAST(retained_clv_usd AS DOUBLE) AS retained_clv_usd FROM retention_history""")
def _(lake):
    return lake.outcomes


# ---- joins ----

_VIEW = """s.subscriber_id, s.plan_type, s.tenure_months, CAST(s.monthly_arpu_usd AS DOUBLE) AS monthly_arpu_usd, s.service_node_id, s.home_metro, s.churn_risk_score, s.churn_reason,
  s.open_ticket_count, s.has_open_outage, CAST(s.clv_at_risk_usd AS DOUBLE) AS clv_at_risk_usd, s.risk_band, s.service_summary, r.recommended_offer,
  CAST(r.predicted_retained_clv_usd AS DOUBLE) AS predicted_retained_clv_usd FROM position_v s LEFT JOIN recs_v r ON r.subscriber_id = s.subscriber_id"""


@query("atrisk_view", f"SELECT {_VIEW} WHERE s.risk_band IN ('critical', 'elevated') ORDER BY s.clv_at_risk_usd DESC, s.subscriber_id LIMIT 50")
def atrisk_view(lake):
    return gold.atrisk_view(lake.scored)


@query("atrisk_with_offer", f"SELECT {_VIEW}")
def _(lake):
    # The recommendations come as a table of their own here, so the position is computed once.
    lake.pin("position")
    return gold.with_offer(lake.position, lake.recs).select(*gold.VIEW_COLS)


@query("plan_discount_side", """SELECT b.subscriber_id, b.churn_reason, CAST(b.clv_at_risk_usd AS DOUBLE) AS clv_at_risk_usd, CAST(r.predicted_retained_clv_usd AS DOUBLE) AS predicted_retained_clv_usd
  FROM recs_v r JOIN book_v b ON r.subscriber_id = b.subscriber_id WHERE r.recommended_offer = 'plan_upgrade_discount'""")
def _(lake):
    lake.pin("book")
    return (lake.recs.filter(F.col("recommended_offer") == "plan_upgrade_discount")
            .join(lake.book, "subscriber_id")
            .select("subscriber_id", "churn_reason", "clv_at_risk_usd", "predicted_retained_clv_usd"))


@query("recommendation_table", """SELECT r.subscriber_id, s.sub_display_name, s.plan_type, r.recommended_offer, CAST(r.predicted_retained_clv_usd AS DOUBLE) AS predicted_retained_clv_usd,
  CAST(r.predicted_net_value_usd AS DOUBLE) AS predicted_net_value_usd FROM recs_v r JOIN position_v s ON r.subscriber_id = s.subscriber_id""")
def _(lake):
    names = lake["subscribers"].select("subscriber_id", "sub_display_name", "plan_type")
    return (lake.recs.join(names, "subscriber_id")
            .select("subscriber_id", "sub_display_name", "plan_type", "recommended_offer",
                    "predicted_retained_clv_usd", "predicted_net_value_usd")
            .orderBy(F.desc("predicted_net_value_usd"), "subscriber_id"))


@query("non_cohort", "SELECT s.subscriber_id, s.plan_type FROM subscribers s WHERE s.subscriber_id NOT IN (SELECT subscriber_id FROM cohort_v)")
def _(lake):
    return lake["subscribers"].join(lake.cohort, "subscriber_id", "left_anti").select("subscriber_id", "plan_type")


@query("dense_risk_grid", """SELECT c.subscriber_id, g.day, r.churn_risk_score, r.churn_risk_score IS NOT NULL AS has_snapshot
  FROM cohort_v c CROSS JOIN (SELECT CAST(unnest(generate_series(DATE '2024-01-17', DATE '2024-01-30', INTERVAL 1 DAY)) AS DATE) AS day) g
  LEFT JOIN risk_snapshots r ON r.subscriber_id = c.subscriber_id AND r.snapshot_date = g.day""")
def _(lake):
    # Each cohort row explodes to a fixed number of days, so no cross join is planned.
    days = F.sequence(F.date_sub(F.lit(lake.p.as_of), 13), F.lit(lake.p.as_of))
    grid = lake.cohort.select("subscriber_id", F.explode(days).alias("day"))
    seen = lake.recent_snapshots(14).select("subscriber_id", F.col("snapshot_date").alias("day"), "churn_risk_score")
    return (grid.join(seen, ["subscriber_id", "day"], "left")
            .withColumn("has_snapshot", F.col("churn_risk_score").isNotNull()))


# ---- measures ----

_MEASURES = """CAST(SUM(clv_at_risk_usd) AS DOUBLE) AS clv_at_risk, CAST(SUM(open_ticket_count) AS BIGINT) AS open_tickets, COUNT(*) AS subscriber_count,
  CAST(SUM(CASE WHEN risk_band = 'critical' THEN 1 ELSE 0 END) AS BIGINT) AS critical_count, CAST(SUM(CASE WHEN risk_band = 'elevated' THEN 1 ELSE 0 END) AS BIGINT) AS elevated_count,
  CAST(SUM(CASE WHEN risk_band IN ('critical', 'elevated') THEN 1 ELSE 0 END) AS BIGINT) AS atrisk_count,
  ROUND(CAST(SUM(CAST(churn_risk_score AS DECIMAL(10,6))) AS DOUBLE) / COUNT(churn_risk_score), 6) AS avg_churn_risk,
  ROUND(CAST(SUM(CAST(churn_signal_score AS DECIMAL(10,6))) AS DOUBLE) / NULLIF(COUNT(churn_signal_score), 0), 6) AS avg_churn_signal"""

for _name, _dim in (("metric_by_plan", "plan_type"), ("metric_by_band", "risk_band"), ("metric_by_reason", "churn_reason"),
                    ("metric_by_metro", "home_metro"), ("metric_by_node", "service_node_id")):
    query(_name, f"SELECT {_dim}, {_MEASURES} FROM position_v GROUP BY {_dim}")(
        lambda lake, d=_dim: metrics.answer(lake.position, None, [d]))


@query("metric_total", f"SELECT {_MEASURES} FROM position_v")
def _(lake):
    return metrics.metric(lake.position)


_CUBE = """SELECT plan_type, churn_reason, risk_band, home_metro, CAST(SUM(clv_at_risk_usd) AS DOUBLE) AS clv_at_risk, CAST(SUM(open_ticket_count) AS BIGINT) AS open_tickets,
  COUNT(*) AS subscriber_count, CAST(SUM(CASE WHEN risk_band = 'critical' THEN 1 ELSE 0 END) AS BIGINT) AS critical_count, CAST(SUM(CASE WHEN risk_band = 'elevated' THEN 1 ELSE 0 END) AS BIGINT) AS elevated_count,
  CAST(SUM(CASE WHEN risk_band IN ('critical', 'elevated') THEN 1 ELSE 0 END) AS BIGINT) AS atrisk_count, CAST(SUM(CAST(churn_risk_score AS DECIMAL(10,6))) AS DOUBLE) AS risk_sum,
  COUNT(churn_risk_score) AS risk_n, CAST(SUM(CAST(churn_signal_score AS DECIMAL(10,6))) AS DOUBLE) AS signal_sum, COUNT(churn_signal_score) AS signal_n
  FROM position_v GROUP BY plan_type, churn_reason, risk_band, home_metro"""


@query("metric_cube", _CUBE)
def _(lake):
    return lake.cube


@query("metric_cube_refreshed", _CUBE)
def _(lake):
    """The cube of a week ago, brought up to date by the subscribers whose position changed since."""
    before = cut_lineage(lake.position_at(replace(lake.p, as_of=lake.p.as_of - timedelta(days=7))))
    after = cut_lineage(lake.position)
    store = CubeStore(lake.spark, f"{shared_dir(lake.spark)}/cube-{uuid.uuid4().hex}", after.schema, buckets=8)
    store.refresh(before, batch="a week ago")
    store.refresh(*changed_rows(before, after, "subscriber_id"), batch="today")
    return store.cube()


@query("metric_from_cube", f"SELECT plan_type, churn_reason, {_MEASURES} FROM position_v GROUP BY plan_type, churn_reason")
def _(lake):
    return metrics.answer(lake.position, lake.cube, ["plan_type", "churn_reason"])


@query("exposure_dataset", """SELECT plan_type, churn_reason, risk_band, home_metro, CAST(SUM(clv_at_risk_usd) AS DOUBLE) AS clv_at_risk, CAST(SUM(open_ticket_count) AS BIGINT) AS open_tickets,
  CAST(SUM(CASE WHEN risk_band = 'critical' THEN 1 ELSE 0 END) AS BIGINT) AS critical_count, CAST(SUM(CASE WHEN risk_band IN ('critical', 'elevated') THEN 1 ELSE 0 END) AS BIGINT) AS atrisk_count,
  COUNT(*) AS subscriber_count FROM position_v GROUP BY ALL""")
def _(lake):
    return metrics.exposure_dataset(lake.position)


@query("kpi_counters", """SELECT CAST(SUM(clv_at_risk_usd) AS DOUBLE) AS clv_at_risk, CAST(SUM(open_ticket_count) AS BIGINT) AS open_tickets,
  CAST(SUM(CASE WHEN risk_band = 'critical' THEN 1 ELSE 0 END) AS BIGINT) AS critical_count, CAST(SUM(CASE WHEN risk_band IN ('critical', 'elevated') THEN 1 ELSE 0 END) AS BIGINT) AS atrisk_count FROM position_v""")
def _(lake):
    return metrics.kpi_counters(metrics.exposure_dataset(lake.position))


@query("node_band", "SELECT service_node_id, risk_band, COUNT(*) AS subscribers, CAST(SUM(clv_at_risk_usd) AS DOUBLE) AS clv_at_risk_usd FROM position_v GROUP BY service_node_id, risk_band")
def _(lake):
    return metrics.count_by(lake.position, "service_node_id", "risk_band")


@query("clv_by_plan", "SELECT plan_type, COUNT(*) AS subscribers, CAST(SUM(clv_at_risk_usd) AS DOUBLE) AS clv_at_risk_usd FROM position_v GROUP BY plan_type")
def _(lake):
    return metrics.count_by(lake.position, "plan_type")


@query("risk_mix", """SELECT churn_reason, risk_band, COUNT(*) AS subscribers, CAST(SUM(CASE WHEN risk_band IN ('critical', 'elevated') THEN 1 ELSE 0 END) AS BIGINT) AS atrisk_subscribers
  FROM position_v GROUP BY churn_reason, risk_band""")
def _(lake):
    return metrics.risk_mix(lake.position)


@query("risk_mix_pivot", """SELECT churn_reason, COUNT(*) FILTER (WHERE risk_band = 'critical') AS critical, COUNT(*) FILTER (WHERE risk_band = 'elevated') AS elevated,
  COUNT(*) FILTER (WHERE risk_band = 'watch') AS watch, COUNT(*) FILTER (WHERE risk_band = 'healthy') AS healthy FROM position_v GROUP BY churn_reason""")
def _(lake):
    return metrics.risk_mix_pivot(lake.position, BANDS)


@query("offer_mix", "SELECT recommended_offer, COUNT(*) AS subscribers, CAST(SUM(predicted_retained_clv_usd) AS DOUBLE) AS predicted_retained_clv_usd FROM recs_v GROUP BY recommended_offer")
def _(lake):
    return metrics.offer_mix(lake.recs)


@query("portfolio_retained", """SELECT COUNT(*) AS subscribers, CAST(SUM(predicted_retained_clv_usd) AS DOUBLE) AS predicted_retained_clv_usd,
  CAST(SUM(predicted_net_value_usd) AS DOUBLE) AS predicted_net_value_usd FROM recs_v""")
def _(lake):
    return metrics.portfolio_retained(lake.recs)


_TREND = """SELECT {period} AS period, c.subscriber_id IS NOT NULL AS in_cohort, COUNT(*) AS snapshots,
  ROUND(CAST(SUM(CAST(churn_risk_score AS DECIMAL(10,6))) AS DOUBLE) / COUNT(*), 6) AS avg_churn_risk
  FROM risk_snapshots r LEFT JOIN cohort_v c ON r.subscriber_id = c.subscriber_id
  WHERE snapshot_date > DATE '2024-01-30' - 56 AND snapshot_date <= DATE '2024-01-30' GROUP BY 1, 2"""


@query("risk_trend_daily", _TREND.format(period="snapshot_date"))
def _(lake):
    return metrics.risk_trend(lake.recent_snapshots(7 * lake.p.trend_weeks), lake.pin("position").cohort, lake.p, "day")


@query("risk_trend_weekly", _TREND.format(period="CAST(date_trunc('week', snapshot_date) AS DATE)"))
def _(lake):
    return metrics.risk_trend(lake.recent_snapshots(7 * lake.p.trend_weeks), lake.pin("position").cohort, lake.p, "week")


_OUTCOMES = """SELECT offer_type, churn_reason, COUNT(*) AS n_offers, CAST(SUM(CASE WHEN retained THEN 1 ELSE 0 END) AS BIGINT) AS n_retained,
  ROUND(CAST(SUM(CASE WHEN retained THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*), 6) AS retain_rate, ROUND(CAST(SUM(retained_clv_usd) AS DOUBLE) / COUNT(*), 6) AS avg_retained_usd,
  ROUND(CAST(SUM(offer_cost_usd) AS DOUBLE) / COUNT(*), 6) AS avg_cost_usd, ROUND(CAST(SUM(retained_clv_usd) - SUM(offer_cost_usd) AS DOUBLE) / COUNT(*), 6) AS avg_net_usd,
  ROUND(CAST(SUM(retained_clv_usd) AS DOUBLE) / CAST(SUM(offer_cost_usd) AS DOUBLE), 6) AS retained_per_cost FROM retention_history GROUP BY offer_type, churn_reason"""


@query("offer_outcomes", _OUTCOMES)
def _(lake):
    return metrics.offer_outcomes(lake.outcomes)


@query("best_offer_by_reason", f"""SELECT churn_reason, MAX(CASE WHEN rn = 1 THEN offer_type END) AS best_by_net, MAX(CASE WHEN rr = 1 THEN offer_type END) AS best_by_ratio, MAX(avg_net_usd) AS best_avg_net_usd
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY churn_reason ORDER BY avg_net_usd DESC, offer_type DESC) AS rn, ROW_NUMBER() OVER (PARTITION BY churn_reason ORDER BY retained_per_cost DESC, offer_type DESC) AS rr FROM ({_OUTCOMES}))
  GROUP BY churn_reason""")
def _(lake):
    return metrics.best_offer_by_reason(metrics.offer_outcomes(lake.outcomes))


@query("subscriber_summary", """SELECT COUNT(*) AS total_at_risk, CAST(COALESCE(SUM(CASE WHEN risk_band = 'critical' THEN 1 ELSE 0 END), 0) AS BIGINT) AS total_critical,
  CAST(COALESCE(SUM(CASE WHEN risk_band = 'elevated' THEN 1 ELSE 0 END), 0) AS BIGINT) AS total_elevated, CAST(COALESCE(SUM(clv_at_risk_usd), 0) AS DOUBLE) AS total_clv_at_risk_usd,
  ROUND(CAST(SUM(CAST(churn_risk_score AS DECIMAL(10,6))) AS DOUBLE) / NULLIF(COUNT(*), 0), 6) AS avg_churn_risk_score FROM position_v WHERE risk_band IN ('critical', 'elevated')""")
def _(lake):
    return metrics.subscriber_summary(lake.position)


@query("note_dedup_ratio", "SELECT COUNT(agent_note_text) AS n_notes, COUNT(DISTINCT agent_note_text) AS n_distinct FROM risk_snapshots")
def _(lake):
    return metrics.note_dedup_ratio(lake["risk_snapshots"])


# ---- windows ----

@query("latest_ticket", """SELECT t.subscriber_id, t.latest_ticket_type, b.last_dispute_reason FROM silver_tickets_v t LEFT JOIN silver_billing_v b ON t.subscriber_id = b.subscriber_id""")
def _(lake):
    return (lake.tickets_rollup.select("subscriber_id", "latest_ticket_type")
            .join(lake.billing_rollup.select("subscriber_id", "last_dispute_reason"), "subscriber_id", "left"))


@query("risk_delta", """SELECT subscriber_id, snapshot_date, churn_risk_score, CAST(CAST(churn_risk_score AS DECIMAL(10,6)) - CAST(prev AS DECIMAL(10,6)) AS DOUBLE) AS risk_delta, band, prev_band, prev_band IS NOT NULL AND band <> prev_band AS band_changed
  FROM (SELECT *, LAG(churn_risk_score) OVER w AS prev, LAG(band) OVER w AS prev_band FROM (SELECT subscriber_id, snapshot_date, churn_risk_score,
    CASE WHEN CAST(churn_risk_score AS DECIMAL(10,6)) >= 0.6 THEN 'elevated' WHEN CAST(churn_risk_score AS DECIMAL(10,6)) >= 0.4 THEN 'watch' ELSE 'healthy' END AS band FROM risk_snapshots)
  WINDOW w AS (PARTITION BY subscriber_id ORDER BY snapshot_date))""")
def _(lake):
    from pyspark.sql import Window
    # One snapshot per subscriber and day: a group is bounded by the calendar.
    w = Window.partitionBy("subscriber_id").orderBy("snapshot_date")
    score = F.col("churn_risk_score").cast(rules.SCORE)
    d = lake["risk_snapshots"].select(
        "subscriber_id", "snapshot_date", "churn_risk_score",
        rules.risk_band(F.col("churn_risk_score"), F.lit(0), lake.p).alias("band"))
    return d.select("*", (score - F.lag(score).over(w)).alias("risk_delta"), F.lag("band").over(w).alias("prev_band")
                    ).withColumn("band_changed", F.coalesce(F.col("band") != F.col("prev_band"), F.lit(False)))


@query("changed_rows", """SELECT o.subscriber_id, o.risk_band AS old_risk_band, o.churn_risk_score AS old_churn_risk_score, CAST(o.clv_at_risk_usd AS DOUBLE) AS old_clv_at_risk_usd,
  n.risk_band, n.churn_risk_score, CAST(n.clv_at_risk_usd AS DOUBLE) AS clv_at_risk_usd FROM position_before_v o LEFT JOIN position_v n ON o.subscriber_id = n.subscriber_id
  WHERE o.risk_band IS DISTINCT FROM n.risk_band OR o.churn_risk_score IS DISTINCT FROM n.churn_risk_score OR o.clv_at_risk_usd IS DISTINCT FROM n.clv_at_risk_usd""")
def _(lake):
    return gold.changed_rows(lake.position_at(gold.at(lake.p, date(2024, 1, 29))), lake.position)


# ---- filters and ranked lists ----

@query("subscriber_detail", """SELECT s.subscriber_id, s.plan_type, s.risk_band, s.churn_risk_score, CAST(s.clv_at_risk_usd AS DOUBLE) AS clv_at_risk_usd, s.service_summary, r.recommended_offer,
  CAST(r.predicted_retained_clv_usd AS DOUBLE) AS predicted_retained_clv_usd, CAST(r.predicted_net_value_usd AS DOUBLE) AS predicted_net_value_usd
  FROM position_v s LEFT JOIN recs_v r ON s.subscriber_id = r.subscriber_id WHERE s.subscriber_id = 'SUB-0000043'""")
def _(lake):
    return (lake.of_subscriber("SUB-0000043").scored.filter(F.col("subscriber_id") == "SUB-0000043")
            .select("subscriber_id", "plan_type", "risk_band", "churn_risk_score", "clv_at_risk_usd", "service_summary",
                    "recommended_offer", "predicted_retained_clv_usd", "predicted_net_value_usd"))


@query("worst_subscriber", """SELECT subscriber_id, risk_band, churn_reason, CAST(clv_at_risk_usd AS DOUBLE) AS clv_at_risk_usd FROM position_v WHERE risk_band IN ('critical', 'elevated')
  ORDER BY position_v.clv_at_risk_usd DESC, subscriber_id LIMIT 1""")
def _(lake):
    return (lake.position.filter(F.col("risk_band").isin(*RED))
            .select("subscriber_id", "risk_band", "churn_reason", "clv_at_risk_usd")
            .orderBy(F.desc("clv_at_risk_usd"), "subscriber_id").limit(1))


@query("risk_scatter", """SELECT subscriber_id, plan_type, tenure_months, CAST(monthly_arpu_usd AS DOUBLE) AS monthly_arpu_usd, churn_risk_score, churn_reason, risk_band FROM position_v
  WHERE risk_band <> 'healthy' OR CAST(substr(subscriber_id, 5) AS BIGINT) % 100 < 5""")
def _(lake):
    # The healthy background is a 5% sample by id: sampling is the feature here, and it repeats exactly.
    sampled = F.substring("subscriber_id", 5, 20).cast("bigint") % 100 < 5
    return (lake.position.filter((F.col("risk_band") != "healthy") | sampled)
            .select("subscriber_id", "plan_type", "tenure_months", "monthly_arpu_usd", "churn_risk_score",
                    "churn_reason", "risk_band"))


@query("highest_clv", """SELECT subscriber_id, plan_type, tenure_months, churn_reason, churn_risk_score, CAST(clv_at_risk_usd AS DOUBLE) AS clv_at_risk_usd FROM position_v
  WHERE risk_band IN ('critical', 'elevated')""")
def _(lake):
    return (lake.position.filter(F.col("risk_band").isin(*RED))
            .select("subscriber_id", "plan_type", "tenure_months", "churn_reason", "churn_risk_score", "clv_at_risk_usd")
            .orderBy(F.desc("clv_at_risk_usd"), "subscriber_id"))


@query("watch_list", "SELECT subscriber_id, plan_type, churn_reason, churn_risk_score FROM position_v WHERE risk_band = 'watch'")
def _(lake):
    return (lake.position.filter(F.col("risk_band") == "watch")
            .select("subscriber_id", "plan_type", "churn_reason", "churn_risk_score")
            .orderBy(F.desc("churn_risk_score"), "subscriber_id"))


@query("drill_reason_topk", """SELECT churn_reason, rank, subscriber_id, risk_band, clv_at_risk_usd FROM (SELECT churn_reason, subscriber_id, risk_band, CAST(clv_at_risk_usd AS DOUBLE) AS clv_at_risk_usd,
  CAST(ROW_NUMBER() OVER (PARTITION BY churn_reason ORDER BY position_v.clv_at_risk_usd DESC, subscriber_id) AS INT) AS rank FROM position_v WHERE risk_band IN ('critical', 'elevated')) WHERE rank <= 5""")
def _(lake):
    return gold.worst_by_reason(lake.position, 5).select(
        "churn_reason", "rank", "subscriber_id", "risk_band", "clv_at_risk_usd")
