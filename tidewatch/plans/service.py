"""Queries of the serving side: actions, chat, search, change history, mirrors."""

from __future__ import annotations

import uuid
from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from tidewatch.functions import rules
from tidewatch.functions import text as X
from tidewatch.operators import actions as A
from tidewatch.operators import conversations as C
from tidewatch.operators import gold
from tidewatch.operators import history as H
from tidewatch.operators import returns as R
from tidewatch.operators import search as S
from tidewatch.operators.text_index import TextIndex
from tidewatch.operators.vector_index import VectorIndex
from tidewatch.plans.registry import SQL, query
from tidewatch.session import shared_dir
from tidewatch.sources import mirror

# ---- actions ----


@query("latest_action", "SELECT subscriber_id, action_id, action_type, offer_type, outcome, agent_id, created_at FROM latest_action_v")
def _(lake):
    return A.latest_action(lake["action_log"])


_STATE = """SELECT p.*, a.action_id AS last_action_id, a.offer_type AS last_offer, a.outcome AS last_outcome, COALESCE(a.outcome IN ('approved', 'retained'), false) AS offer_applied
  FROM position_v p LEFT JOIN latest_action_v a ON p.subscriber_id = a.subscriber_id"""


@query("live_state", f"SELECT subscriber_id, risk_band, CAST(clv_at_risk_usd AS DOUBLE) AS clv_at_risk_usd, last_action_id, last_offer, last_outcome, offer_applied FROM ({_STATE})")
def _(lake):
    return A.live_state(lake.position, lake["action_log"]).select(
        "subscriber_id", "risk_band", "clv_at_risk_usd", "last_action_id", "last_offer", "last_outcome", "offer_applied")


_CARE = f"""SELECT subscriber_id, plan_type, home_metro, tenure_months, churn_risk_score, churn_reason, CAST(clv_at_risk_usd AS DOUBLE) AS clv_at_risk_usd, risk_band, offer_applied FROM ({_STATE}) q WHERE risk_band <> 'healthy'"""
_CARE_COLS = ("subscriber_id", "plan_type", "home_metro", "tenure_months", "churn_risk_score", "churn_reason",
              "clv_at_risk_usd", "risk_band", "offer_applied")

for _name, _sql, _args in (
        ("care_queue", "", {}),
        ("care_queue_applied", "AND offer_applied", {"tab": "applied"}),
        ("care_queue_filtered", "AND plan_type = 'mobile' AND churn_reason = 'service'", {"plan_type": "mobile", "churn_reason": "service", "risk_band": None}),
        ("care_queue_search", "AND (lower(subscriber_id) LIKE '%an%' OR lower(plan_type) LIKE '%an%' OR lower(home_metro) LIKE '%an%')", {"search": "AN "}),
        ("care_queue_by_clv", "AND risk_band = 'elevated' ORDER BY q.clv_at_risk_usd DESC, subscriber_id", {"tab": "elevated"}),
        ("care_queue_by_risk", "ORDER BY churn_risk_score DESC, subscriber_id", {"sort": "risk"}),
        ("care_queue_by_tenure", "ORDER BY tenure_months DESC, subscriber_id", {"sort": "tenure"})):
    query(_name, f"{_CARE} {_sql}")(
        lambda lake, a=_args: A.care_queue(A.live_state(lake.position, lake["action_log"]), **a).select(*_CARE_COLS))


@query("care_kpis", f"""SELECT CAST(SUM(clv_at_risk_usd) AS DOUBLE) AS clv_at_risk_usd, CAST(SUM(CASE WHEN offer_applied THEN 0 ELSE clv_at_risk_usd END) AS DOUBLE) AS clv_open_usd,
  CAST(SUM(open_ticket_count) AS BIGINT) AS open_tickets, COUNT(*) FILTER (WHERE risk_band IN ('critical', 'elevated')) AS atrisk_count,
  COUNT(*) FILTER (WHERE risk_band IN ('critical', 'elevated') AND NOT offer_applied) AS atrisk_open_count, COUNT(*) FILTER (WHERE offer_applied) AS applied_count FROM ({_STATE})""")
def _(lake):
    return A.care_kpis(A.live_state(lake.position, lake["action_log"]))


@query("live_kpi", """SELECT d.day, d.n_actions, d.n_applied, COALESCE(s.newly_saved, 0) AS newly_saved, CAST(COALESCE(s.clv_drop_usd, 0) AS DOUBLE) AS clv_drop_usd FROM
  (SELECT CAST(created_at AS DATE) AS day, COUNT(*) AS n_actions, COUNT(*) FILTER (WHERE outcome IN ('approved', 'retained')) AS n_applied FROM retention_actions GROUP BY 1) d
  LEFT JOIN (SELECT f.day, COUNT(*) AS newly_saved, SUM(p.clv_at_risk_usd) AS clv_drop_usd FROM (SELECT subscriber_id, CAST(MIN(created_at) AS DATE) AS day FROM retention_actions WHERE outcome IN ('approved', 'retained') GROUP BY subscriber_id) f
    JOIN position_v p ON p.subscriber_id = f.subscriber_id WHERE p.risk_band IN ('critical', 'elevated') GROUP BY f.day) s ON s.day = d.day""")
def _(lake):
    return A.live_kpi(lake.position, lake["action_log"])


@query("actions_on_atrisk", "SELECT a.action_id, a.subscriber_id, a.action_type, a.outcome FROM retention_actions a WHERE a.subscriber_id IN (SELECT subscriber_id FROM cohort_v)")
def _(lake):
    return (lake["action_log"].join(lake.cohort, "subscriber_id", "left_semi")
            .select("action_id", "subscriber_id", "action_type", "outcome"))


@query("priority_score", """SELECT action_id, subscriber_id, outcome, created_at, CAST(CASE outcome WHEN 'escalated' THEN 95 WHEN 'pending' THEN 80 WHEN 'retained' THEN 10 WHEN 'approved' THEN 0 END AS DOUBLE) AS priority_score
  FROM retention_actions""")
def _(lake):
    return A.priority(lake["action_log"])


def _notes(lake):
    return lake["documents"].select(F.col("doc_id").alias("note_doc"), F.col("text").alias("notes"))


@query("recent_actions", """SELECT action_id, subscriber_id, action_type, offer_type, outcome, agent_id, created_at, CASE WHEN length(notes) > 60 THEN substr(notes, 1, 60) || '...' ELSE notes END AS notes_preview
  FROM retention_actions ORDER BY created_at DESC, action_id DESC LIMIT 20""")
def _(lake):
    return A.recent_actions(lake["action_log"], _notes(lake))


def _requests(lake):
    """Two approvers ask for every action, and one for as many ids that do not exist."""
    acts = lake["action_log"]
    known = acts.select("action_id", F.explode(F.array(F.lit(1), F.lit(2))).alias("request_id"))
    unknown = acts.select((-F.col("action_id") - 1).alias("action_id"), F.lit(1).alias("request_id"))
    return known.unionByName(unknown).withColumn("approver", F.concat(F.lit("lead-"), F.col("request_id")))


@query("approve_actions", """SELECT action_id, 'lead-1' AS approver, CAST(2 AS BIGINT) AS n_requests, CASE WHEN outcome = 'pending' THEN 'approved' ELSE 'not_pending' END AS result FROM retention_actions
  UNION ALL SELECT -action_id - 1, 'lead-1', 1, 'not_found' FROM retention_actions""")
def _(lake):
    return A.approval_report(lake["action_log"], _requests(lake))


@query("approved_log", """SELECT action_id, subscriber_id, CASE WHEN outcome = 'pending' THEN 'approved' ELSE outcome END AS outcome,
  CASE WHEN outcome = 'pending' THEN 'lead-1' ELSE agent_id END AS agent_id, outcome = 'pending' AS was_updated FROM retention_actions""")
def _(lake):
    return A.approve_actions(lake["action_log"], _requests(lake)).select(
        "action_id", "subscriber_id", "outcome", "agent_id", "was_updated")


_AT = "2024-01-30T00:00:00Z"


@query("record_actions", f"""SELECT sha256(b.subscriber_id || '|' || r.recommended_offer || '|{_AT}') AS id, b.subscriber_id, r.recommended_offer AS offer_type,
  CASE b.churn_reason WHEN 'service' THEN 'OFFER-001' WHEN 'price' THEN 'OFFER-003' ELSE 'OFFER-005' END AS offer_id, 'Offer ' || r.recommended_offer || ' for reason ' || b.churn_reason AS drafted_summary,
  CAST(r.predicted_retained_clv_usd AS DOUBLE) AS predicted_retained_clv_usd, 'approved' AS status, 'care-lead' AS approved_by,
  '[{{"at":"{_AT}","by":"care-lead","action":"approved","notes":"Retention action recorded","tool":"record_action"}}]' AS audit_trail, '{_AT}' AS created_at, '{_AT}' AS decided_at
  FROM book_v b JOIN recs_v r ON b.subscriber_id = r.subscriber_id""")
def _(lake):
    offers = gold.candidate_offer(lake["offers"])
    asked = (lake.scored.filter(F.col("recommended_offer").isNotNull())
             .withColumn("t", rules.offer_for_reason(F.col("churn_reason")))
             .join(offers.withColumnRenamed("offer_type", "t"), "t", "left")
             .select("subscriber_id", F.col("recommended_offer").alias("offer_type"), F.col("candidate_offer_id").alias("offer_id"),
                     F.concat(F.lit("Offer "), "recommended_offer", F.lit(" for reason "), "churn_reason").alias("drafted_summary"),
                     "predicted_retained_clv_usd"))
    rows = A.record_actions(asked, "care-lead", F.lit(_AT))
    return rows.withColumn("audit_trail", F.to_json("audit_trail"))


@query("audit_append", """SELECT action_id, CASE WHEN outcome = 'approved' THEN 2 ELSE 1 END AS n_entries,
  '[{"at":"' || CAST(CAST(created_at AS DATE) AS VARCHAR) || '","by":"' || agent_id || '","action":"proposed","notes":"' || action_type || '","tool":"app"}' ||
  CASE WHEN outcome = 'approved' THEN ',{"at":"' || CAST(CAST(created_at AS DATE) AS VARCHAR) || '","by":"lead","action":"approved","notes":"offer accepted","tool":"app"}' ELSE '' END || ']' AS audit_trail
  FROM retention_actions""")
def _(lake):
    day = F.col("created_at").cast("date").cast("string")
    rows = lake["action_log"].withColumn("audit_trail", F.array(
        rules.audit_entry(day, F.col("agent_id"), F.lit("proposed"), F.col("action_type"), F.lit("app"))))
    done = rules.audit_entry(day, F.lit("lead"), F.lit("approved"), F.lit("offer accepted"), F.lit("app"))
    return A.append_audit(rows, done, F.col("outcome") == "approved").select(
        "action_id", F.size("audit_trail").alias("n_entries"), F.to_json("audit_trail").alias("audit_trail"))


_RAW_ACTIONS = """SELECT action_id, CASE WHEN action_id % 13 = 0 THEN 'follow_up_call' ELSE action_type END AS action_type, CASE WHEN action_id % 17 = 0 THEN 'loyalty_discount' ELSE offer_type END AS offer_type,
  CASE WHEN action_id % 19 = 0 THEN NULL ELSE outcome END AS outcome FROM retention_actions"""


@query("enum_violations", f"""SELECT action_id, 'action_type' AS field, action_type AS value FROM ({_RAW_ACTIONS}) WHERE action_type NOT IN ('offer_presented', 'follow_up', 'escalation')
  UNION ALL SELECT action_id, 'outcome', outcome FROM ({_RAW_ACTIONS}) WHERE outcome IS NULL
  UNION ALL SELECT action_id, 'offer_type', offer_type FROM ({_RAW_ACTIONS}) WHERE offer_type NOT IN ('bill_credit', 'plan_upgrade_discount', 'device_upgrade')""")
def _(lake):
    a = F.col("action_id")
    raw = lake["action_log"].select(
        "action_id", F.when(a % 13 == 0, "follow_up_call").otherwise(F.col("action_type")).alias("action_type"),
        F.when(a % 17 == 0, "loyalty_discount").otherwise(F.col("offer_type")).alias("offer_type"),
        F.when(a % 19 != 0, F.col("outcome")).alias("outcome"))
    return A.enum_violations(raw)


# ---- tiered decisions on returns ----

_FACILITY = "Brand#12"
_CURRENT = "SELECT * REPLACE (CASE WHEN status = 'pending' AND customer_id % 10 = 3 THEN 'rejected' ELSE status END AS status) FROM silver_returns"


def _attempted(lake):
    return lake["silver_returns"].filter((F.col("facility") == _FACILITY) & (F.col("status") == "pending"))


def _current(lake):
    return lake["silver_returns"].withColumn(
        "status", F.when((F.col("status") == "pending") & (F.col("customer_id") % 10 == 3), "rejected").otherwise(F.col("status")))


def _updated(lake, where):
    """The rows that meet the filter, where some were decided between read and write."""
    return A.bulk_tiered_action(_current(lake), lake["return_customers"], where, "care-agent",
                                F.col("return_date").cast("string"))


_PCT = "CASE WHEN r.final_tier = 'premium' THEN 20 ELSE 5 END"
_CODE = f"'SAVE' || {_PCT} || '-' || upper(substr(md5(r.facility || '|' || {_PCT}), 1, 6))"
_FIRST = "split_part(c.customer_name, ' ', 1)"
_LAST = "substr(c.customer_name, length(split_part(c.customer_name, ' ', 1)) + 2)"
_SUBJECT = f"CASE WHEN r.final_tier = 'premium' THEN 'We are sorry, ' || {_FIRST} ELSE 'About your return' END"
_BODY = f"""CASE WHEN r.final_tier = 'premium' THEN 'Dear ' || {_FIRST} || ' ' || {_LAST} || ', use ' || {_CODE} || ' for 20% off after ' || r.product_name || '.'
  ELSE 'Hello ' || {_FIRST} || ', use ' || {_CODE} || ' for 5% off after ' || r.product_name || '.' END"""
_ORIGIN = """CASE WHEN final_tier = 'premium' AND premium_status_labeled = 'premium' THEN 'premium, tagged by hand' WHEN final_tier = 'premium' THEN 'premium, hidden' ELSE 'standard' END"""
_UPDATED = f"""SELECT r.*, {_PCT} AS coupon_pct, {_CODE} AS coupon_code, {_ORIGIN} AS origin, {_SUBJECT} AS subject, {_BODY} AS body
  FROM ({_CURRENT}) r LEFT JOIN return_customers c ON r.customer_id = c.customer_id WHERE r.status = 'pending'"""
_AT_FACILITY = f"facility = '{_FACILITY}'"


@query("bulk_tiered_action", f"""SELECT return_id, lot_id, customer_id, final_tier, CAST(refund_amount_usd AS DOUBLE) AS refund_amount_usd, coupon_pct, coupon_code, 'approved' AS status, origin, subject, body,
  CAST(return_date AS VARCHAR) AS at, 'email_sent,approved' AS audit_actions FROM ({_UPDATED}) WHERE facility = '{_FACILITY}'""")
def _(lake):
    return _updated(lake, F.expr(_AT_FACILITY)).select(
        "return_id", "lot_id", "customer_id", "final_tier", "refund_amount_usd", "coupon_pct", "coupon_code", "status", "origin",
        F.col("emails")[0]["subject"].alias("subject"), F.col("emails")[0]["body"].alias("body"), F.col("emails")[0]["at"].alias("at"),
        F.array_join(F.transform("audit_trail", lambda a: a["action"]), ",").alias("audit_actions"))


_LOT = "LOT-000012"


@query("bulk_action_by_lot", f"""SELECT return_id, lot_id, customer_id, final_tier, coupon_pct, coupon_code, 'approved' AS status, subject FROM ({_UPDATED}) WHERE lot_id = '{_LOT}'""")
def _(lake):
    return _updated(lake, F.col("lot_id") == _LOT).select(
        "return_id", "lot_id", "customer_id", "final_tier", "coupon_pct", "coupon_code", "status", F.col("emails")[0]["subject"].alias("subject"))


@query("return_detail", f"""SELECT r.return_id, r.lot_id, r.facility, r.product_name, CASE WHEN u.return_id IS NULL THEN r.status ELSE 'approved' END AS status, r.final_tier, r.premium_status_labeled,
  CAST(p.premium_prob AS DOUBLE) AS premium_prob, r.anger_score, CAST(r.refund_amount_usd AS DOUBLE) AS refund_amount_usd, c.customer_name, COALESCE(u.subject, '') AS email_subjects,
  CASE WHEN u.return_id IS NULL THEN '' ELSE 'email_sent,approved' END AS audit_actions
  FROM ({_CURRENT}) r JOIN return_customers c ON c.customer_id = r.customer_id LEFT JOIN premium_predictions p ON p.customer_id = r.customer_id LEFT JOIN ({_UPDATED}) u ON u.return_id = r.return_id
  WHERE r.return_id = (SELECT MIN(return_id) FROM silver_returns WHERE status = 'pending')""")
def _(lake):
    # The return that a user picks: here the first one that is pending.
    picked = lake["silver_returns"].filter("status = 'pending'").agg(F.min("return_id")).first()[0]
    one = lake.of_return(picked)
    return R.return_detail(_current(one), one["return_customers"], one["premium_predictions"], _updated(one, F.lit(True)), picked)


@query("bulk_action_summary", f"""SELECT COUNT(*) AS attempted_count, COUNT(*) FILTER (WHERE done) AS approved_count, COUNT(*) FILTER (WHERE done AND final_tier = 'premium') AS premium_email_count,
  COUNT(*) FILTER (WHERE done AND final_tier IS DISTINCT FROM 'premium') AS standard_email_count, COUNT(*) FILTER (WHERE done AND {_ORIGIN} = 'premium, tagged by hand') AS premium_labeled_count,
  COUNT(*) FILTER (WHERE done AND {_ORIGIN} = 'premium, hidden') AS premium_predicted_hidden_count, CAST(COALESCE(SUM(CASE WHEN done THEN refund_amount_usd END), 0) AS DOUBLE) AS total_refund_usd, COUNT(*) FILTER (WHERE NOT done) AS skipped_count
  FROM (SELECT *, customer_id % 10 <> 3 AS done FROM silver_returns WHERE facility = '{_FACILITY}' AND status = 'pending')""")
def _(lake):
    return A.bulk_action_summary(_updated(lake, F.expr(_AT_FACILITY)), _attempted(lake))


@query("bulk_skipped", f"SELECT return_id FROM silver_returns WHERE facility = '{_FACILITY}' AND status = 'pending' AND customer_id % 10 = 3")
def _(lake):
    return A.skipped_rows(_updated(lake, F.expr(_AT_FACILITY)), _attempted(lake))


@query("decide_rows", """SELECT return_id, CASE WHEN ok THEN decision ELSE status END AS status, ok AS was_updated,
  CASE WHEN ok THEN '[{"at":"2024-01-30","by":"lead","action":"' || decision || '","tool":"decide"}]' ELSE '[]' END AS audit_trail
  FROM (SELECT *, status = 'pending' AND decision <> 'cancelled' AS ok FROM (SELECT return_id, status, CASE customer_id % 4 WHEN 0 THEN 'approved' WHEN 1 THEN 'rejected' WHEN 2 THEN 'escalated' ELSE 'cancelled' END AS decision
    FROM silver_returns))""")
def _(lake):
    c = F.col("customer_id")
    asked = lake["silver_returns"].select(
        "return_id", F.when(c % 4 == 0, "approved").when(c % 4 == 1, "rejected").when(c % 4 == 2, "escalated").otherwise("cancelled").alias("decision"),
        F.lit("lead").alias("by"), c.alias("request_id"))
    rows = A.decide_rows(lake["silver_returns"].select("return_id", "status"), asked, F.lit("2024-01-30"))
    return rows.withColumn("audit_trail", F.to_json("audit_trail"))


@query("render_messages", f"SELECT r.return_id, {_SUBJECT} AS subject, {_BODY} AS body FROM silver_returns r JOIN return_customers c ON r.customer_id = c.customer_id")
def _(lake):
    return A.render_messages(lake["silver_returns"], lake["return_customers"])


_ITEMS = f"""SELECT return_id, CAST(return_date AS VARCHAR) AS happened_at, 'email' AS kind, 'outgoing' AS action, subject AS detail, NULL AS actor FROM ({_UPDATED})
  UNION ALL SELECT return_id, CAST(return_date AS VARCHAR), 'audit', 'email_sent', origin, 'care-agent' FROM ({_UPDATED})
  UNION ALL SELECT return_id, CAST(return_date AS VARCHAR), 'audit', 'approved', origin, 'care-agent' FROM ({_UPDATED})"""


@query("activity_feed", f"SELECT return_id, happened_at, kind, action, detail, CAST(actor AS VARCHAR) AS actor FROM ({_ITEMS}) ORDER BY happened_at DESC, return_id, kind, action LIMIT 20")
def _(lake):
    return A.activity_feed(_updated(lake, F.lit(True))).withColumnsRenamed({"at": "happened_at", "by": "actor"})


@query("entity_timeline", f"""SELECT return_id, happened_at, kind, action, detail, CAST(actor AS VARCHAR) AS actor, CAST(ROW_NUMBER() OVER (PARTITION BY return_id ORDER BY happened_at DESC, kind DESC, action DESC) - 1 AS INT) AS position FROM ({_ITEMS})""")
def _(lake):
    return A.entity_timeline(_updated(lake, F.lit(True))).withColumnsRenamed({"at": "happened_at", "by": "actor"})


def _usd(column: str) -> str:
    return f"'$' || format('{{{{:,.2f}}}}', CAST(COALESCE({column}, 0) AS DOUBLE))"


@query("decision_memos", f"""SELECT b.subscriber_id, concat_ws(chr(10), '# Retention Decision Memo', '', '**Subscriber**: ' || b.subscriber_id, '**Date**: 2024-01-30', '', '## Risk Assessment', '- **Risk Score**: ' || CAST(churn_risk_score AS VARCHAR),
  '- **Risk Band**: ' || risk_band, '- **Churn Reason**: ' || churn_reason, '- **CLV at Risk**: ' || {_usd('clv_at_risk_usd')}, '', '## Subscriber Profile', '- **Plan**: ' || plan_type, '- **Tenure**: ' || CAST(tenure_months AS VARCHAR) || ' months',
  '- **ARPU**: ' || {_usd('monthly_arpu_usd')} || '/mo', '- **Node**: ' || service_node_id, '- **Metro**: ' || home_metro, '', '## Service Summary', service_summary, '', '## Recommendation', '- **Offer**: ' || recommended_offer,
  '- **Predicted Retained CLV**: ' || {_usd('predicted_retained_clv_usd')}, '- **Net Value**: ' || {_usd('predicted_net_value_usd')}, '', '## Decision', '- [ ] Approve recommended offer', '- [ ] Escalate to manager',
  '- [ ] Custom offer: _______________', '', '**Approver**: _______________', '**Signature**: _______________') AS memo FROM book_v b JOIN recs_v r ON b.subscriber_id = r.subscriber_id""".replace("{{", "{").replace("}}", "}"))
def _(lake):
    return A.decision_memos(lake.scored, lake.p.as_of.isoformat())


# ---- model spend ----

@query("spend_attribution", """SELECT p.subscriber_id, CAST(SUM(p.n) AS BIGINT) AS actions, CAST(SUM(s.cost * p.n // t.total) AS DOUBLE) / 100000000 AS attributed_cost_usd
  FROM (SELECT agent_id, subscriber_id, COUNT(*) AS n FROM retention_actions GROUP BY agent_id, subscriber_id) p JOIN (SELECT agent_id, COUNT(*) AS total FROM retention_actions GROUP BY agent_id) t ON t.agent_id = p.agent_id
  JOIN (SELECT agent_id, CAST(SUM(cost_usd) * 100000000 AS BIGINT) AS cost FROM model_calls GROUP BY agent_id) s ON s.agent_id = p.agent_id GROUP BY p.subscriber_id""")
def _(lake):
    return A.spend_attribution(lake["model_calls"], lake["action_log"])


@query("spend_cap", """SELECT conversation_id, call_seq, tokens, CAST(cost_usd AS DOUBLE) AS cost_usd, CAST(run AS DOUBLE) AS running_cost_usd, run > 0.01 AS over_cap, run > 0.01 AND run - cost_usd <= 0.01 AS first_breach
  FROM (SELECT *, SUM(cost_usd) OVER (PARTITION BY conversation_id ORDER BY call_seq) AS run FROM model_calls)""")
def _(lake):
    return A.spend_cap(lake["model_calls"], F.lit(Decimal("0.01")), lake.p)


# ---- chat ----

@query("message_positions", """SELECT conversation_id, position, ROW_NUMBER() OVER (PARTITION BY conversation_id ORDER BY position) - 1 AS dense_position,
  ROW_NUMBER() OVER (PARTITION BY conversation_id ORDER BY position) - 1 = position AS in_sequence FROM messages""")
def _(lake):
    return C.message_positions(lake["messages"], lake.p)


@query("next_positions", "SELECT conversation_id, MAX(position) + 1 AS next_position, COUNT(*) - COUNT(DISTINCT position) AS n_duplicates FROM messages GROUP BY conversation_id")
def _(lake):
    return C.next_positions(lake["messages"])


@query("append_messages", """SELECT i.conversation_id, i.arrival, COALESCE(m.top, -1) + ROW_NUMBER() OVER (PARTITION BY i.conversation_id ORDER BY i.arrival) AS position
  FROM (SELECT conversation_id, position * 3 AS arrival FROM messages WHERE role = 'assistant') i
  LEFT JOIN (SELECT conversation_id, MAX(position) AS top FROM messages WHERE role <> 'assistant' GROUP BY conversation_id) m ON m.conversation_id = i.conversation_id""")
def _(lake):
    # The stored messages are those of users; the answers arrive later.
    stored = lake["messages"].filter("role <> 'assistant'")
    later = lake["messages"].filter("role = 'assistant'").select("conversation_id", (F.col("position") * 3).alias("arrival"))
    return C.append_messages(stored, later, lake.p)


@query("sanitize_history", """SELECT m.conversation_id, m.position, m.role, md5(m.content) AS content_md5 FROM messages m JOIN (SELECT conversation_id, arg_max(role, position) AS last_role FROM messages
  WHERE role IN ('user', 'assistant') AND length(trim(content)) > 0 GROUP BY conversation_id) e ON e.conversation_id = m.conversation_id
  WHERE e.last_role = 'user' AND m.role IN ('user', 'assistant') AND length(trim(m.content)) > 0""")
def _(lake):
    return C.sanitize_history(lake["messages"]).select("conversation_id", "position", "role", F.md5("content").alias("content_md5"))


@query("conversation_title", """SELECT conversation_id, CASE WHEN length(first) > 48 THEN substr(first, 1, 48) || '…' ELSE first END AS title
  FROM (SELECT conversation_id, arg_min(content, position) FILTER (WHERE role = 'user') AS first FROM messages GROUP BY conversation_id)""")
def _(lake):
    return C.conversation_titles(lake["messages"])


@query("conversation_messages", "SELECT conversation_id, position, role, content FROM messages WHERE conversation_id = 3")
def _(lake):
    return C.ordered_messages(lake["messages"], 3)


@query("conversation_list", """SELECT 'user-' || CAST(conversation_id % 7 AS VARCHAR) AS user_id, conversation_id, COUNT(*) AS n_messages, MAX(position) AS last_position
  FROM messages GROUP BY conversation_id""")
def _(lake):
    owned = lake["messages"].withColumn("user_id", F.concat(F.lit("user-"), (F.col("conversation_id") % 7).cast("string")))
    return C.conversation_list(owned)


_SCRIPT = (C.Step("Why are they leaving?"), C.Step("Rank the offers", ("the", " de ")), C.Step("Apply it", ("approved",)))


@query("next_step", """SELECT m.conversation_id, CASE WHEN NOT m.sent0 THEN 'Why are they leaving?' WHEN NOT m.sent1 THEN CASE WHEN contains(m.last, 'the') OR contains(m.last, ' de ') THEN 'Rank the offers' END
  WHEN NOT m.sent2 THEN CASE WHEN contains(m.last, 'approved') THEN 'Apply it' END END AS next_prompt FROM (
  SELECT conversation_id, COALESCE(lower(arg_max(content, position) FILTER (WHERE role = 'assistant')), '') AS last, COALESCE(bool_or(role = 'user' AND lower(trim(content)) = 'why are they leaving?'), false) AS sent0,
    COALESCE(bool_or(role = 'user' AND lower(trim(content)) = 'rank the offers'), false) AS sent1, COALESCE(bool_or(role = 'user' AND lower(trim(content)) = 'apply it'), false) AS sent2
  FROM (SELECT conversation_id, position, role, CASE WHEN role = 'user' AND position < 2 AND conversation_id % 2 = 0 THEN ' why are they LEAVING?' WHEN role = 'user' AND position > 1 AND conversation_id % 4 = 0 THEN 'Rank the offers' ELSE content END AS content FROM messages)
  GROUP BY conversation_id) m""")
def _(lake):
    c, n, user = F.col("conversation_id"), F.col("position"), F.col("role") == "user"
    chat = lake["messages"].withColumn("content", F.when(user & (n < 2) & (c % 2 == 0), " why are they LEAVING?")
                                       .when(user & (n > 1) & (c % 4 == 0), "Rank the offers").otherwise(F.col("content")))
    return C.next_step(chat, _SCRIPT)


@query("pair_tool_calls", """SELECT c.conversation_id, c.call_id, c.seq, c.name, c.args, o.output FROM (SELECT * FROM thinking_events WHERE kind = 'tool_call') c
  LEFT JOIN (SELECT * FROM thinking_events WHERE kind = 'tool_output') o ON o.conversation_id = c.conversation_id AND o.call_id = c.call_id AND o.seq > c.seq
  UNION ALL SELECT o.conversation_id, o.call_id, o.seq, '(unknown)', '', o.output FROM thinking_events o WHERE o.kind = 'tool_output'
  AND NOT EXISTS (SELECT 1 FROM thinking_events c WHERE c.kind = 'tool_call' AND c.conversation_id = o.conversation_id AND c.call_id = o.call_id AND c.seq < o.seq)""")
def _(lake):
    return C.pair_tool_calls(lake["thinking_events"])


@query("feedback_rollup", "SELECT conversation_id, COUNT(*) FILTER (WHERE value = 'up') AS up, COUNT(*) FILTER (WHERE value = 'down') AS down FROM feedback GROUP BY conversation_id")
def _(lake):
    return C.feedback_rollup(lake["feedback"])


@query("extract_entity_id", """SELECT ticket_id, CASE WHEN CAST(substr(ticket_id, 5) AS BIGINT) % 3 = 0 THEN NULL ELSE subscriber_id END AS subscriber_id FROM tickets""")
def _(lake):
    # A sentence that names the subscriber, another id later on, and one without any id.
    n = F.substring("ticket_id", 5, 20).cast("bigint")
    said = F.when(n % 3 == 0, F.concat(F.col("note_text"), F.lit(" xSUB-1"))).otherwise(
        F.concat(F.lit("call about "), F.col("subscriber_id"), F.lit(",; not SUB-0000000. "), F.col("note_text")))
    return C.entity_mentions(lake["tickets"].withColumn("said", said), "said").select("ticket_id", "subscriber_id")


# ---- search ----

_STOP = ", ".join(f"'{w}'" for w in X.STOP_WORDS)
_WORDS = "list_filter(regexp_extract_all(lower({c}), '[a-z0-9]+'), lambda w: w NOT IN (" + _STOP + "))"


def _bm25_sql(source: str, id_col: str, text: str, terms: list[str], where: str = "true", extra: str = "") -> str:
    """Score by the textbook formula over unnested words."""
    tfs = ", ".join(f"len(list_filter(w, lambda x: x = '{t}')) AS tf{i}" for i, t in enumerate(terms))
    dfs = ", ".join(f"COUNT(*) FILTER (WHERE tf{i} > 0) AS df{i}" for i in range(len(terms)))
    score = " + ".join(f"ln(1 + (s.n - s.df{i} + 0.5) / (s.df{i} + 0.5)) * d.tf{i} * 2.2 / (d.tf{i} + 1.2 * (0.25 + 0.75 * d.len / s.avg_len))" for i in range(len(terms)))
    anyhit = " OR ".join(f"d.tf{i} > 0" for i in range(len(terms)))
    return f"""WITH words AS (SELECT *, {_WORDS.format(c=text)} AS w FROM {source}),
  d AS (SELECT *, len(w) AS len, ' ' || list_aggregate(w, 'string_agg', ' ') || ' ' AS normal, {tfs} FROM words),
  s AS (SELECT COUNT(*) AS n, CAST(SUM(len) AS DOUBLE) / COUNT(*) AS avg_len, {dfs} FROM d),
  scored AS (SELECT d.*, ROUND({score}, 6) AS score FROM d CROSS JOIN s WHERE ({anyhit}) AND ({where}))
  SELECT {id_col}, score {extra} FROM scored ORDER BY score DESC, {id_col}"""


_NOTE_QUERY = 'thanea attion or "thanea worthless" or eriner -ringing'
_NOTE_TERMS = ["thanea", "attion", "worthless", "eriner"]
_NOTE_WHERE = """(contains(normal, ' thanea ') AND contains(normal, ' attion ')) OR contains(normal, ' thanea worthless ') OR (contains(normal, ' eriner ') AND NOT contains(normal, ' ringing '))"""


@query("note_search", _bm25_sql("retention_actions", "action_id", "notes", _NOTE_TERMS, _NOTE_WHERE, ", subscriber_id, action_type, outcome") + " LIMIT 5")
def _(lake):
    return S.quoted_note_search(lake["action_log"], _notes(lake), "action_id", _NOTE_QUERY, ["subscriber_id", "action_type", "outcome"])


@query("bm25_topk", _bm25_sql("documents", "doc_id", "text", ["thanea", "attion", "eriner", "thanedble"]) + " LIMIT 5")
def _(lake):
    return S.bm25_topk(lake["documents"].select("doc_id", "text"), "doc_id", "text", "thanea or attion or eriner or thanedble")


def _index(lake, docs, id_col, text_col, **how):
    """An index of the documents, which come in three batches; in a service the index stays and only batches come."""
    index = TextIndex(lake.spark, f"{shared_dir(lake.spark)}/index-{uuid.uuid4().hex}", **how)
    for part in range(3):
        index.add(docs.filter(F.pmod(F.xxhash64(id_col), F.lit(3)) == part), id_col, text_col, batch=str(part))
    return index


@query("indexed_topk", _bm25_sql("documents", "doc_id", "text", ["thanea", "attion", "eriner", "thanedble"]) + " LIMIT 5")
def _(lake):
    found = _index(lake, lake["documents"].select("doc_id", "text"), "doc_id", "text", fanout=2).topk("thanea or attion or eriner or thanedble", 5)
    return found.rows.withColumnRenamed("id", "doc_id")


@query("indexed_search", _bm25_sql("documents", "doc_id", "text", _NOTE_TERMS, _NOTE_WHERE) + " LIMIT 20")
def _(lake):
    return _index(lake, lake["documents"].select("doc_id", "text"), "doc_id", "text").topk(_NOTE_QUERY, 20, boolean=True).rows.withColumnRenamed("id", "doc_id")


@query("similar_cases", _bm25_sql("retention_actions", "action_id", "notes", _NOTE_TERMS, f"outcome = 'retained' AND ({_NOTE_WHERE})", ", subscriber_id, offer_type") + " LIMIT 5")
def _(lake):
    return S.quoted_note_search(lake["action_log"], _notes(lake), "action_id", _NOTE_QUERY, ["subscriber_id", "offer_type"],
                                keep=F.col("outcome") == "retained")


_DOCS = """(SELECT 'ticket' AS source, ticket_id AS doc_id, subscriber_id AS scope, opened_date AS happened_on, ticket_type || ' ' || note_text AS doc FROM tickets
  UNION ALL SELECT 'bill', bill_id, subscriber_id, bill_month, 'dispute ' || dispute_reason FROM billing WHERE dispute_reason IS NOT NULL
  UNION ALL SELECT 'event', event_id, node_id, event_date, 'network ' || event_type FROM network_events)"""
_HITS = _bm25_sql(_DOCS, "doc_id", "doc", ["outage", "dispute", "leave"], "contains(normal, ' outage ') OR contains(normal, ' dispute ') OR contains(normal, ' leave ')", ", source, scope, happened_on")


# The words of the texts that share a stem with the query below.
_STEMS = {"disput": ("dispute", "disputes"), "outag": ("outage",), "resolv": ("resolved",), "routin": ("routine",)}
_STEMMED = "lower(doc)"
for _stem, _forms in _STEMS.items():
    _STEMMED = f"regexp_replace({_STEMMED}, '\\b({'|'.join(_forms)})\\b', '{_stem}', 'g')"


@query("note_search_stemmed", _bm25_sql(f"(SELECT doc_id, {_STEMMED} AS stemmed FROM {_DOCS})", "doc_id", "stemmed", ["disput", "network", "outag", "resolv"],
       "contains(normal, ' disput ') OR contains(normal, ' network outag ') OR (contains(normal, ' resolv ') AND NOT contains(normal, ' routin '))") + " LIMIT 20")
def _(lake):
    docs = S.history_documents(lake["tickets"], lake["network_events"], lake["billing"])
    index = _index(lake, docs, "doc_id", "doc", stemmed=True, range_docs=1024)
    return index.topk('disputing or "network outages" or resolving -routinely', 20, boolean=True).rows.withColumnRenamed("id", "doc_id")


@query("history_search", f"""SELECT subscriber_id, source, doc_id, happened_on, score, CAST(rn AS INT) AS rank FROM (SELECT b.subscriber_id, h.source, h.doc_id, h.happened_on, h.score,
  ROW_NUMBER() OVER (PARTITION BY b.subscriber_id ORDER BY h.score DESC, h.happened_on DESC, h.doc_id) AS rn FROM position_v b JOIN ({_HITS}) h ON h.scope = b.subscriber_id OR h.scope = b.service_node_id) WHERE rn <= 5""")
def _(lake):
    return S.history_search(lake["tickets"], lake["network_events"], lake["billing"], lake.position, "outage or dispute or leave", 5).withColumnRenamed("at", "happened_on")


_ONE = "SUB-0000043"
_OWN = f"(SELECT d.* FROM {_DOCS} d WHERE d.scope = '{_ONE}' OR d.scope = (SELECT service_node_id FROM position_v WHERE subscriber_id = '{_ONE}'))"


@query("subscriber_history_search", "SELECT '" + _ONE + "' AS subscriber_id, source, doc_id, happened_on, score, CAST(ROW_NUMBER() OVER (ORDER BY score DESC, happened_on DESC, doc_id) AS INT) AS rank FROM (" + _bm25_sql(
    _OWN, "doc_id", "doc", ["outage", "dispute", "leave"], "contains(normal, ' outage ') OR contains(normal, ' dispute ') OR contains(normal, ' leave ')", ", source, happened_on")
    + ") ORDER BY rank LIMIT 5")
def _(lake):
    one = lake.of_subscriber(_ONE)
    return S.history_search(one["tickets"], lake["network_events"], one["billing"], one.position, "outage or dispute or leave", 5, _ONE).withColumnRenamed("at", "happened_on")


@query("offer_search", f"""WITH e AS (SELECT offer_id, {_WORDS.format(c="offer_name || ' ' || description")} AS w FROM offers WHERE is_active),
  s AS (SELECT COUNT(*) AS n, AVG(len(w)) AS avg_len FROM e), t AS (SELECT offer_id, len(w) AS len, unnest(w) AS word FROM e),
  tf AS (SELECT offer_id, len, word, COUNT(*) AS tf FROM t GROUP BY ALL), df AS (SELECT word, COUNT(*) AS df FROM tf GROUP BY word),
  wt AS (SELECT tf.word, offer_id, ln(1 + (s.n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / s.avg_len)) AS weight FROM tf JOIN df ON df.word = tf.word CROSS JOIN s),
  q AS (SELECT note_text, COUNT(*) AS n_tickets FROM tickets GROUP BY note_text),
  qw AS (SELECT note_text, n_tickets, unnest(list_distinct({_WORDS.format(c='note_text')})) AS word FROM q),
  r AS (SELECT note_text, n_tickets, offer_id, ROUND(SUM(weight), 6) AS score FROM qw JOIN wt ON wt.word = qw.word GROUP BY note_text, n_tickets, offer_id)
  SELECT note_text, n_tickets, offer_id, score, CAST(rn AS INT) AS rank FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY note_text ORDER BY score DESC, offer_id) AS rn FROM r) WHERE rn <= 5""")
def _(lake):
    return S.offer_search(lake["tickets"], lake["offers"], 5)


@query("vector_topk", """SELECT e.vec_id, e.label, ROUND(list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])), 6) AS cosine
  FROM embeddings e CROSS JOIN (SELECT embedding FROM embeddings WHERE vec_id = 0) q ORDER BY cosine DESC, e.vec_id LIMIT 10""")
def _(lake):
    return S.vector_topk(lake["embeddings"], lake["embeddings"].filter("vec_id = 0"))


@query("vector_index_topk", SQL["vector_topk"])
def _(lake):
    index = VectorIndex(lake.spark, f"{shared_dir(lake.spark)}/vectors-{uuid.uuid4().hex}", cells=16)
    vectors = lake["embeddings"]
    for part in range(2):
        index.add(vectors.filter(F.pmod("vec_id", F.lit(2)) == part), "vec_id", "embedding")
    found = index.search_exactly(vectors.filter("vec_id = 0").first().embedding)
    return found.rows.join(vectors.select(F.col("vec_id").alias("id"), "label"), "id").select(F.col("id").alias("vec_id"), "label", "cosine").orderBy(F.desc("cosine"), "vec_id")


@query("anger_score", f"""SELECT doc_id, CASE WHEN {' OR '.join(f"contains(lower(text), '{w}')" for w in X.ANGRY_WORDS)} THEN CAST(1 AS DOUBLE)
  WHEN {' OR '.join(f"contains(lower(text), '{w}')" for w in X.CALM_WORDS)} THEN CAST(0 AS DOUBLE) ELSE CAST(0.5 AS DOUBLE) END AS anger_score FROM documents""")
def _(lake):
    return S.note_classes(lake["documents"], "doc_id", "text")


@query("fix_mojibake", "SELECT doc_id, md5(text) AS repaired_md5, true AS is_restored FROM documents")
def _(lake):
    # Each text is misread as Latin-1 and then repaired.
    garbled = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    fixed = X.repair_mojibake(garbled)
    return lake["documents"].select("doc_id", F.md5(fixed).alias("repaired_md5"), (fixed == F.col("text")).alias("is_restored"))


# ---- change history ----

@query("scd2_history", """SELECT entity_key, lsn, state, valid_from, valid_to, is_current FROM (SELECT entity_key, lsn, state, change_type, changed_at AS valid_from, LEAD(changed_at) OVER w AS valid_to,
  LEAD(lsn) OVER w IS NULL AS is_current FROM change_feed WINDOW w AS (PARTITION BY entity_key ORDER BY lsn)) WHERE change_type <> 'delete'""")
def _(lake):
    return H.scd2(lake["change_feed"], lake.p)


@query("cdc_latest_state", """SELECT entity_key, lsn, state, changed_at FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY entity_key ORDER BY lsn DESC) AS rn FROM change_feed) WHERE rn = 1 AND change_type <> 'delete'""")
def _(lake):
    return H.latest_state(lake["change_feed"])


_CHAIN = """SELECT subscriber_id, action_date, COUNT(*) AS n_events, MIN(event_id) FILTER (WHERE event_type = 'risk_trigger') AS risk_trigger, MIN(event_id) FILTER (WHERE event_type = 'offer_recommended') AS offer_recommended,
  MIN(event_id) FILTER (WHERE event_type = 'action_submitted') AS action_submitted, MIN(event_id) FILTER (WHERE event_type = 'action_approved') AS action_approved FROM workflow_state GROUP BY subscriber_id, action_date"""


@query("decision_chain", f"""SELECT *, concat_ws(',', CASE WHEN risk_trigger IS NULL THEN 'risk_trigger' END, CASE WHEN offer_recommended IS NULL THEN 'offer_recommended' END, CASE WHEN action_submitted IS NULL THEN 'action_submitted' END,
  CASE WHEN action_approved IS NULL THEN 'action_approved' END) AS missing_steps, CASE WHEN risk_trigger IS NULL OR offer_recommended IS NULL OR action_submitted IS NULL OR action_approved IS NULL THEN 'incomplete'
  WHEN risk_trigger < offer_recommended AND offer_recommended < action_submitted AND action_submitted < action_approved THEN 'complete' ELSE 'out_of_order' END AS verdict FROM ({_CHAIN})""")
def _(lake):
    return H.decision_chains(lake["workflow_state"])


# ---- mirrors ----

@query("publish_mirror", """SELECT subscriber_id, risk_band, CAST(clv_at_risk_usd AS DOUBLE) AS clv_at_risk_usd FROM position_before_v WHERE risk_band <> 'healthy'
  UNION ALL SELECT subscriber_id, risk_band, CAST(clv_at_risk_usd AS DOUBLE) FROM position_v WHERE subscriber_id NOT IN (SELECT subscriber_id FROM position_before_v WHERE risk_band <> 'healthy')""")
def _(lake):
    cols = ("subscriber_id", "risk_band", "clv_at_risk_usd")
    # The mirror holds yesterday's at-risk book; everybody else is added.
    before = gold.at_risk_book(lake.position_at(gold.at(lake.p, date(2024, 1, 29))))
    return mirror.merged(before.select(*cols), lake.position.select(*cols), "subscriber_id")


@query("enum_coerce", """SELECT b.subscriber_id, CASE WHEN CAST(substr(b.subscriber_id, 5) AS BIGINT) % 4 = 0 THEN 'healthy' ELSE b.risk_band END AS risk_band,
  CASE WHEN CAST(substr(b.subscriber_id, 5) AS BIGINT) % 5 = 0 THEN NULL ELSE r.recommended_offer END AS recommended_offer FROM position_v b LEFT JOIN recs_v r ON r.subscriber_id = b.subscriber_id""")
def _(lake):
    n = F.substring("subscriber_id", 5, 20).cast("bigint")
    dirty = lake.scored.select(
        "subscriber_id", F.when(n % 4 == 0, "unknown").otherwise(F.col("risk_band")).alias("risk_band"),
        F.when(n % 5 == 0, "gift").otherwise(F.col("recommended_offer")).alias("recommended_offer"))
    return dirty.select("subscriber_id", mirror.coerce_band(F.col("risk_band")).alias("risk_band"),
                        mirror.coerce_offer(F.col("recommended_offer")).alias("recommended_offer"))


@query("ranking_json_roundtrip", """SELECT subscriber_id, CASE WHEN CAST(substr(subscriber_id, 5) AS BIGINT) % 5 IN (0, 1, 2) THEN 0 ELSE 3 END AS n_options,
  CASE WHEN CAST(substr(subscriber_id, 5) AS BIGINT) % 5 IN (0, 1, 2) THEN NULL ELSE recommended_offer END AS best_offer,
  CASE WHEN CAST(substr(subscriber_id, 5) AS BIGINT) % 5 IN (0, 1, 2) THEN NULL ELSE CAST(predicted_net_value_usd AS DOUBLE) END AS best_net_usd FROM recs_v""")
def _(lake):
    # Some texts are missing, cut off, or not an array.
    n = F.substring("subscriber_id", 5, 20).cast("bigint") % 5
    raw = (F.when(n == 0, F.lit(None).cast("string")).when(n == 1, F.expr("left(offer_ranking, length(offer_ranking) - 9)"))
           .when(n == 2, F.concat(F.lit('{"a":'), "offer_ranking", F.lit("}"))).otherwise(F.col("offer_ranking")))
    parsed = lake.recs.select("subscriber_id", mirror.parse_ranking(raw).alias("r"))
    return parsed.select("subscriber_id", F.size("r").alias("n_options"), F.get("r", F.lit(0))["offerType"].alias("best_offer"),
                         F.get("r", F.lit(0))["predictedNetValueUsd"].alias("best_net_usd"))


_CELLS = """SELECT p_partkey, unnest([p_name, CAST(p_size AS VARCHAR), CAST(p_retailprice AS VARCHAR), '-' || CAST(p_size AS VARCHAR), p_brand, '1e' || CAST(p_size AS VARCHAR)]) AS cell FROM part"""


@query("numeric_coerce", f"SELECT p_partkey, cell, CASE WHEN regexp_full_match(cell, '-?[0-9]+(\\.[0-9]+)?') THEN TRY_CAST(cell AS DOUBLE) END AS cell_num FROM ({_CELLS})")
def _(lake):
    size = F.col("p_size").cast("string")
    cells = lake["part"].select("p_partkey", F.explode(F.array(
        F.col("p_name"), size, F.col("p_retailprice").cast("string"), F.concat(F.lit("-"), size), F.col("p_brand"),
        F.concat(F.lit("1e"), size))).alias("cell"))
    return mirror.numeric_cells(cells, ["cell"])
