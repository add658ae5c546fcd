"""Reference SQL of the silver and gold tables, used only to check query results."""

from __future__ import annotations

from tidewatch.sources.adapters import VIEW_SQL

SQL_VIEWS: dict[str, str] = dict(VIEW_SQL)

SQL_VIEWS["note_churn_flags_v"] = """
SELECT agent_note_text, note_class, CASE note_class WHEN 'churn_signal' THEN CAST(1.0 AS DOUBLE) WHEN 'at_risk' THEN CAST(0.6 AS DOUBLE) ELSE CAST(0.1 AS DOUBLE) END AS churn_signal_score
FROM (SELECT agent_note_text, CASE
    WHEN lower(agent_note_text) LIKE '%not resolved%' OR lower(agent_note_text) LIKE '%threatening to leave%' OR lower(agent_note_text) LIKE '%no service since%'
      OR lower(agent_note_text) LIKE '%down twice%' OR lower(agent_note_text) LIKE '%will cancel%' THEN 'churn_signal'
    WHEN lower(agent_note_text) LIKE '%routine support call, resolved%' OR lower(agent_note_text) LIKE '%satisfied, no issues%' THEN 'healthy'
    ELSE 'at_risk' END AS note_class
  FROM (SELECT DISTINCT agent_note_text FROM risk_snapshots WHERE agent_note_text IS NOT NULL))
"""

SQL_VIEWS["silver_tickets_v"] = """
SELECT subscriber_id, CAST(SUM(CASE WHEN closed_date IS NULL THEN 1 ELSE 0 END) AS INT) AS open_ticket_count,
  MAX(CASE WHEN closed_date IS NULL AND ticket_type = 'outage' THEN 1 ELSE 0 END) = 1 AS has_open_outage,
  MAX(CASE WHEN closed_date IS NULL AND ticket_type = 'billing' THEN 1 ELSE 0 END) = 1 AS has_open_billing,
  MAX(CASE WHEN rn = 1 THEN ticket_type END) AS latest_ticket_type
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY subscriber_id ORDER BY opened_date DESC, ticket_id DESC) AS rn FROM tickets)
GROUP BY subscriber_id
"""

SQL_VIEWS["silver_billing_v"] = """
SELECT subscriber_id, MAX(CASE WHEN disputed AND bill_month >= DATE '2023-12-01' THEN 1 ELSE 0 END) = 1 AS has_recent_dispute,
  MAX(CASE WHEN dispute_reason IS NOT NULL AND rn = 1 THEN dispute_reason END) AS last_dispute_reason
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY subscriber_id ORDER BY CASE WHEN dispute_reason IS NULL THEN 1 ELSE 0 END, bill_month DESC, bill_id DESC) AS rn FROM billing)
GROUP BY subscriber_id
"""

SQL_VIEWS["silver_risk_v"] = """
SELECT r.*, s.plan_type, s.tenure_months, s.monthly_arpu_usd, s.service_node_id, s.home_metro, f.churn_signal_score
FROM risk_snapshots r JOIN subscribers s ON r.subscriber_id = s.subscriber_id LEFT JOIN note_churn_flags_v f ON r.agent_note_text = f.agent_note_text
"""


def position_sql(as_of: str) -> str:
    return f"""
SELECT c.subscriber_id, s.sub_display_name, s.plan_type, s.tenure_months, s.monthly_arpu_usd, s.service_node_id, s.home_metro, s.sub_lat, s.sub_lng,
  s.service_summary, c.snapshot_date, c.churn_risk_score, c.churn_reason, COALESCE(t.open_ticket_count, 0) AS open_ticket_count,
  COALESCE(t.has_open_outage, false) AS has_open_outage, COALESCE(t.has_open_billing, false) AS has_open_billing,
  COALESCE(b.has_recent_dispute, false) AS has_recent_dispute, f.churn_signal_score,
  CASE WHEN CAST(c.churn_risk_score AS DECIMAL(10,6)) >= 0.6 THEN CAST(s.monthly_arpu_usd * 24 * CAST(c.churn_risk_score AS DECIMAL(10,6)) AS DECIMAL(12,2)) ELSE CAST(0 AS DECIMAL(12,2)) END AS clv_at_risk_usd,
  CASE WHEN CAST(c.churn_risk_score AS DECIMAL(10,6)) >= 0.75 AND COALESCE(t.open_ticket_count, 0) > 0 THEN 'critical'
    WHEN CAST(c.churn_risk_score AS DECIMAL(10,6)) >= 0.6 THEN 'elevated' WHEN CAST(c.churn_risk_score AS DECIMAL(10,6)) >= 0.4 THEN 'watch' ELSE 'healthy' END AS risk_band
FROM (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY subscriber_id ORDER BY snapshot_date DESC) AS rn FROM risk_snapshots WHERE snapshot_date <= DATE '{as_of}') WHERE rn = 1) c
JOIN subscribers s ON c.subscriber_id = s.subscriber_id
LEFT JOIN silver_tickets_v t ON t.subscriber_id = c.subscriber_id
LEFT JOIN silver_billing_v b ON b.subscriber_id = c.subscriber_id
LEFT JOIN note_churn_flags_v f ON f.agent_note_text = c.agent_note_text
"""


SQL_VIEWS["position_v"] = position_sql("2024-01-30")
SQL_VIEWS["position_before_v"] = position_sql("2024-01-29")
SQL_VIEWS["book_v"] = "SELECT * FROM position_v WHERE risk_band IN ('critical', 'elevated', 'watch')"

SQL_VIEWS["plays_v"] = """
SELECT *, retained_clv_usd - cost_usd AS net_value_usd, CAST(ROW_NUMBER() OVER (PARTITION BY subscriber_id ORDER BY retained_clv_usd - cost_usd DESC, ord) AS INT) AS offer_rank
FROM (
  SELECT subscriber_id, 0 AS ord, 'bill_credit' AS offer_type, CAST(40 AS DECIMAL(12,2)) AS cost_usd, CAST(clv_at_risk_usd * CASE WHEN churn_reason = 'service' THEN 0.70 ELSE 0.30 END AS DECIMAL(12,2)) AS retained_clv_usd FROM book_v
  UNION ALL SELECT subscriber_id, 1, 'plan_upgrade_discount', CAST(monthly_arpu_usd * 0.2 * 12 AS DECIMAL(12,2)), CAST(clv_at_risk_usd * CASE WHEN churn_reason = 'price' THEN 0.65 ELSE 0.30 END AS DECIMAL(12,2)) FROM book_v
  UNION ALL SELECT subscriber_id, 2, 'device_upgrade', CAST(300 AS DECIMAL(12,2)), CAST(clv_at_risk_usd * CASE WHEN churn_reason = 'device' THEN 0.60 ELSE 0.25 END AS DECIMAL(12,2)) FROM book_v)
"""

SQL_VIEWS["recs_v"] = """
SELECT subscriber_id, MAX(CASE WHEN offer_rank = 1 THEN offer_type END) AS recommended_offer,
  MAX(CASE WHEN offer_rank = 1 THEN retained_clv_usd END) AS predicted_retained_clv_usd, MAX(CASE WHEN offer_rank = 1 THEN net_value_usd END) AS predicted_net_value_usd,
  '[' || string_agg('{"offerType":"' || offer_type || '","costUsd":' || CAST(cost_usd AS VARCHAR) || ',"predictedRetainedClvUsd":' || CAST(retained_clv_usd AS VARCHAR) || ',"predictedNetValueUsd":' || CAST(net_value_usd AS VARCHAR) || '}', ',' ORDER BY offer_rank) || ']' AS offer_ranking
FROM plays_v GROUP BY subscriber_id
"""

SQL_VIEWS["open_atrisk_v"] = """
SELECT b.*, e.event_id AS linked_event_id, e.event_type AS linked_event_type, e.event_date AS linked_event_date,
  CASE b.churn_reason WHEN 'service' THEN 'OFFER-001' WHEN 'price' THEN 'OFFER-003' ELSE 'OFFER-005' END AS candidate_offer_id
FROM book_v b LEFT JOIN (SELECT * FROM (SELECT p.subscriber_id, n.event_id, n.event_type, n.event_date,
    ROW_NUMBER() OVER (PARTITION BY p.subscriber_id ORDER BY n.event_date DESC, n.event_id DESC) AS rn
  FROM book_v p JOIN network_events n ON n.node_id = p.service_node_id AND n.event_date <= p.snapshot_date AND n.event_date >= p.snapshot_date - 30
  WHERE p.churn_reason = 'service') WHERE rn = 1) e ON e.subscriber_id = b.subscriber_id
"""

SQL_VIEWS["cohort_v"] = "SELECT subscriber_id FROM position_v WHERE risk_band IN ('critical', 'elevated')"

SQL_VIEWS["latest_action_v"] = """
SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY subscriber_id ORDER BY created_at DESC, action_id DESC) AS rn FROM retention_actions) WHERE rn = 1
"""
