"""Views that map the order/event tables onto the retention and returns model.

The statements are plain SQL that means the same in Spark and in other SQL
engines.  ``adapter_views`` binds each one to DataFrames, so nothing is
registered in the session catalog and every view stays lazily planned: columns
a query does not use are pruned down to the parquet scan.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

VIEW_SQL: dict[str, str] = {}

VIEW_SQL["subscribers"] = """
SELECT 'SUB-' || lpad(CAST(c.c_custkey + 1 AS STRING), 7, '0') AS subscriber_id, c.c_name AS sub_display_name,
  CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'mobile' WHEN 'MACHINERY' THEN 'mobile' WHEN 'BUILDING' THEN 'broadband' WHEN 'HOUSEHOLD' THEN 'broadband' ELSE 'bundle' END AS plan_type,
  CAST(3 + c.c_custkey % 90 AS INT) AS tenure_months,
  CAST(45 + (CAST(c.c_acctbal AS DECIMAL(12,2)) + 1000) * 0.007 AS DECIMAL(9,2)) AS monthly_arpu_usd,
  'NODE-' || substr(r.r_name, 1, 2) || '-' || lpad(CAST(c.c_custkey % 40 + 1 AS STRING), 2, '0') AS service_node_id,
  n.n_name AS home_metro, r.r_name AS state,
  CAST(25 + n.n_nationkey AS DOUBLE) AS sub_lat, CAST(-120 + 2 * n.n_nationkey AS DOUBLE) AS sub_lng,
  DATE '2024-01-30' - CAST((3 + c.c_custkey % 90) * 30 AS INT) AS activation_date,
  'tenure ' || CAST(3 + c.c_custkey % 90 AS STRING) || ' months, region ' || r.r_name || ', segment ' || c.c_mktsegment AS service_summary,
  true AS is_active, c.c_custkey AS custkey
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
"""

VIEW_SQL["offers"] = """
SELECT 'OFFER-001' AS offer_id, 'Bill credit 50' AS offer_name, 'bill_credit' AS offer_type, CAST(50 AS DOUBLE) AS value_usd, 'all' AS segment, 'one time credit for a service outage or billing dispute' AS description, true AS is_active
UNION ALL SELECT 'OFFER-002', 'Bill credit 100', 'bill_credit', CAST(100 AS DOUBLE), 'high_value', 'larger credit for a high value subscriber with a service grievance', true
UNION ALL SELECT 'OFFER-003', 'Plan discount', 'plan_upgrade_discount', CAST(0.2 AS DOUBLE), 'all', 'recurring discount for a price driven churn reason', true
UNION ALL SELECT 'OFFER-004', 'Unlimited discount', 'plan_upgrade_discount', CAST(0.15 AS DOUBLE), 'mobile', 'discounted unlimited plan for price sensitive mobile', true
UNION ALL SELECT 'OFFER-005', 'Device upgrade', 'device_upgrade', CAST(300 AS DOUBLE), 'high_value', 'subsidised device for a device driven churn reason', true
"""

VIEW_SQL["tickets"] = """
SELECT 'TKT-' || lpad(CAST(event_id + 1 AS STRING), 8, '0') AS ticket_id,
  'SUB-' || lpad(CAST(user_id + 1 AS STRING), 7, '0') AS subscriber_id,
  CASE event_type WHEN 'error' THEN 'outage' WHEN 'purchase' THEN 'billing' WHEN 'click' THEN 'technical' ELSE 'general' END AS ticket_type,
  CAST(ts AS DATE) AS opened_date,
  CASE WHEN event_id % 41 = 0 THEN NULL ELSE CAST(ts AS DATE) + CAST(1 + event_id % 5 AS INT) END AS closed_date,
  CASE event_id % 3 WHEN 0 THEN 'phone' WHEN 1 THEN 'chat' ELSE 'app' END AS channel,
  CASE WHEN event_id % 41 <> 0 THEN 'routine support call, resolved' WHEN event_type = 'error' THEN 'called about outage, not resolved' ELSE 'disputes bill, threatening to leave' END AS note_text
FROM events
"""

# The window runs over one row per user and day, so its groups are bounded by the calendar.  Customers without events come by a join: in a
# NOT EXISTS a filter for one customer would replace the key by its value and leave a join without a key.
VIEW_SQL["risk_snapshots"] = """
WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, SUM(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS e, COUNT(*) AS a,
    SUM(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS p, SUM(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS k, MIN(event_id) AS eid
  FROM events GROUP BY user_id, CAST(ts AS DATE)),
w AS (SELECT user_id, day, eid, SUM(e) OVER x AS e7, SUM(a) OVER x AS a7, SUM(p) OVER x AS p7, SUM(k) OVER x AS k7 FROM d
  WINDOW x AS (PARTITION BY user_id ORDER BY day RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW))
SELECT 'SUB-' || lpad(CAST(user_id + 1 AS STRING), 7, '0') AS subscriber_id, day AS snapshot_date,
  CAST(LEAST(950, 50 + 90 * e7 + 10 * a7) AS DOUBLE) / 1000 AS churn_risk_score,
  CASE WHEN e7 >= p7 AND e7 >= k7 THEN 'service' WHEN p7 >= k7 THEN 'price' ELSE 'device' END AS churn_reason,
  CAST(e7 AS INT) AS open_ticket_count,
  CASE WHEN eid % 5 = 0 THEN NULL WHEN e7 >= 6 THEN 'escalated, wants credit or will cancel' WHEN e7 >= 4 THEN 'no service since the outage' WHEN e7 >= 2 THEN 'routine support call, resolved' ELSE 'satisfied, no issues' END AS agent_note_text
FROM w
UNION ALL
SELECT 'SUB-' || lpad(CAST(c.c_custkey + 1 AS STRING), 7, '0'), DATE '2024-01-30', CAST(30 + c.c_custkey % 170 AS DOUBLE) / 1000,
  CASE c.c_custkey % 3 WHEN 0 THEN 'service' WHEN 1 THEN 'price' ELSE 'device' END, 0,
  CASE c.c_custkey % 2 WHEN 0 THEN 'satisfied, no issues' ELSE NULL END
FROM customer c ANTI JOIN event_users e ON e.user_id = c.c_custkey
"""

# A view of its own, so that a reader of the last weeks can bound the events and still see who ever had one.
VIEW_SQL["event_users"] = "SELECT DISTINCT user_id FROM events"

VIEW_SQL["billing"] = """
SELECT 'BILL-' || lpad(CAST(o_orderkey + 1 AS STRING), 8, '0') AS bill_id, 'SUB-' || lpad(CAST(o_custkey + 1 AS STRING), 7, '0') AS subscriber_id,
  CAST(date_trunc('month', o_orderdate + INTERVAL 269 MONTH) AS DATE) AS bill_month,
  CAST(CAST(o_totalprice AS DECIMAL(14,2)) * 0.0003 AS DECIMAL(9,2)) AS amount_usd,
  (o_orderpriority = '1-URGENT' AND o_orderstatus = 'P') AS disputed,
  CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'charged during outage window' ELSE 'billing question' END ELSE NULL END AS dispute_reason
FROM orders
"""

VIEW_SQL["usage"] = """
SELECT 'SUB-' || lpad(CAST(o.o_custkey + 1 AS STRING), 7, '0') AS subscriber_id, CAST(l.l_shipdate + INTERVAL 269 MONTH AS DATE) AS usage_date,
  CAST(l.l_quantity AS DECIMAL(9,2)) AS data_gb, CAST(l.l_linenumber * 10 AS INT) AS voice_min, CAST(CAST(l.l_discount AS DECIMAL(4,2)) * 50 AS DECIMAL(9,2)) AS stream_hours
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
"""

VIEW_SQL["lots"] = """
SELECT 'LOT-' || lpad(CAST(p_partkey AS STRING), 6, '0') AS lot_id, p_partkey AS product_id, p_brand AS facility FROM part
"""

VIEW_SQL["products"] = """
SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category FROM part
"""

VIEW_SQL["network_events"] = """
SELECT 'NEV-' || lpad(CAST(e.event_id + 1 AS STRING), 8, '0') AS event_id, s.service_node_id AS node_id,
  CASE e.event_type WHEN 'error' THEN 'outage' ELSE 'degradation' END AS event_type, CAST(e.ts AS DATE) AS event_date,
  CAST(5 + floor(e.value) AS INT) AS duration_min, CAST(10 + e.event_id % 500 AS INT) AS subscribers_affected
FROM events e JOIN subscribers s ON s.custkey = e.user_id WHERE e.event_type IN ('error','view') AND e.event_id % 7 = 0
"""

VIEW_SQL["retention_history"] = """
WITH b AS (SELECT o.o_orderkey, s.subscriber_id, s.monthly_arpu_usd, CAST(o.o_orderdate + INTERVAL 269 MONTH AS DATE) AS initiated_date,
   CASE o.o_orderkey % 3 WHEN 0 THEN 'bill_credit' WHEN 1 THEN 'plan_upgrade_discount' ELSE 'device_upgrade' END AS offer_type,
   CASE WHEN o.o_orderkey % 9 < 3 THEN 'service' WHEN o.o_orderkey % 9 < 6 THEN 'price' ELSE 'device' END AS churn_reason
   FROM orders o JOIN subscribers s ON s.custkey = o.o_custkey),
m AS (SELECT *, (offer_type='bill_credit' AND churn_reason='service') OR (offer_type='plan_upgrade_discount' AND churn_reason='price') OR (offer_type='device_upgrade' AND churn_reason='device') AS matched FROM b)
SELECT 'RET-' || lpad(CAST(o_orderkey + 1 AS STRING), 8, '0') AS retention_id, subscriber_id, offer_type, churn_reason, monthly_arpu_usd, initiated_date,
  CASE offer_type WHEN 'bill_credit' THEN CAST(50 AS DECIMAL(9,2)) WHEN 'plan_upgrade_discount' THEN CAST(monthly_arpu_usd * 0.2 * 12 AS DECIMAL(9,2)) ELSE CAST(300 AS DECIMAL(9,2)) END AS offer_cost_usd,
  o_orderkey % 100 < CASE WHEN matched THEN 70 ELSE 30 END AS retained,
  CASE WHEN o_orderkey % 100 < CASE WHEN matched THEN 70 ELSE 30 END THEN CAST(monthly_arpu_usd * 24 * CASE WHEN matched THEN 0.7 ELSE 0.3 END AS DECIMAL(12,2)) ELSE CAST(0 AS DECIMAL(12,2)) END AS retained_clv_usd FROM m
"""

# The action log alone; every action has a note, so leaving the notes out keeps all rows
# and spares the queries that never read them the join to the documents.
VIEW_SQL["action_log"] = """
SELECT event_id AS action_id, 'SUB-' || lpad(CAST(user_id + 1 AS STRING), 7, '0') AS subscriber_id,
  CASE event_id % 3 WHEN 0 THEN 'offer_presented' WHEN 1 THEN 'follow_up' ELSE 'escalation' END AS action_type,
  CASE event_id % 4 WHEN 0 THEN 'bill_credit' WHEN 1 THEN 'plan_upgrade_discount' WHEN 2 THEN 'device_upgrade' ELSE NULL END AS offer_type,
  CASE event_type WHEN 'signup' THEN 'pending' WHEN 'purchase' THEN 'approved' WHEN 'click' THEN 'retained' ELSE 'escalated' END AS outcome,
  'agent-' || CAST(event_id % 12 AS STRING) AS agent_id, ts AS created_at, event_id % (SELECT COUNT(*) FROM documents) AS note_doc
FROM events WHERE event_id % 5 = 0
"""

VIEW_SQL["retention_actions"] = """
SELECT a.action_id, a.subscriber_id, a.action_type, a.offer_type, a.outcome, a.agent_id, d.text AS notes, a.created_at
FROM action_log a JOIN documents d ON d.doc_id = a.note_doc
"""

VIEW_SQL["silver_order_items"] = """
SELECT l.l_orderkey AS order_id, 'LOT-' || lpad(CAST(l.l_partkey AS STRING), 6, '0') AS lot_id, r.r_name AS region, CAST(l.l_quantity AS DECIMAL(9,2)) AS quantity
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
"""

VIEW_SQL["silver_returns"] = """
SELECT CAST(l.l_orderkey AS STRING) || '-' || CAST(l.l_linenumber AS STRING) || '-' || CAST(l.l_partkey AS STRING) || '-' || CAST(l.l_suppkey AS STRING) AS return_id,
  'LOT-' || lpad(CAST(l.l_partkey AS STRING), 6, '0') AS lot_id, p.p_brand AS facility, p.p_name AS product_name, c.c_custkey AS customer_id, n.n_name AS city, r.r_name AS country,
  CASE WHEN n.n_nationkey % 11 = 10 THEN NULL ELSE CAST(n.n_nationkey AS DOUBLE) * 2 - 25 END AS customer_lat, CASE WHEN n.n_nationkey % 11 = 10 THEN NULL ELSE CAST(n.n_nationkey AS DOUBLE) * 5 - 60 END AS customer_lng,
  CAST(l.l_shipdate + INTERVAL 269 MONTH AS DATE) AS return_date,
  CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2))) AS DECIMAL(12,2)) AS refund_amount_usd,
  CASE WHEN l.l_linestatus = 'O' THEN 'pending' WHEN l.l_linenumber % 3 = 0 THEN 'approved' WHEN l.l_linenumber % 3 = 1 THEN 'rejected' ELSE 'escalated' END AS status,
  CASE WHEN c.c_custkey % 10 = 9 THEN NULL WHEN c.c_acctbal > 5000 THEN 'premium' ELSE 'standard' END AS final_tier,
  CASE WHEN c.c_mktsegment = 'BUILDING' THEN 'premium' WHEN c.c_mktsegment = 'MACHINERY' THEN 'not_premium' ELSE NULL END AS premium_status_labeled,
  CASE l.l_linenumber % 3 WHEN 0 THEN CAST(0 AS DOUBLE) WHEN 1 THEN CAST(0.5 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS anger_score
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey JOIN part p ON l.l_partkey = p.p_partkey
WHERE l.l_returnflag = 'R'
"""

# Mirror of a tier-prediction table: one row per scored customer.
VIEW_SQL["premium_predictions"] = """
SELECT c_custkey AS customer_id, CASE WHEN c_acctbal > 5000 THEN 'premium' ELSE 'standard' END AS final_tier,
  CAST((CAST(c_acctbal AS DECIMAL(12,2)) + 1000) * 0.00009 AS DECIMAL(6,4)) AS premium_prob
FROM customer WHERE c_custkey % 10 <> 9
"""

VIEW_SQL["return_customers"] = """
SELECT c.c_custkey AS customer_id, c.c_name || ' of ' || n.n_name AS customer_name, n.n_name AS customer_city
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
"""

VIEW_SQL["messages"] = """
SELECT conv_id AS conversation_id, turn AS position, role, text AS content FROM conversations
"""

# Model-call log derived from the chat: one call per assistant message, cost 2 cents per 1,000 words.
VIEW_SQL["model_calls"] = """
SELECT conv_id AS conversation_id, turn AS call_seq, 'agent-' || CAST(conv_id % 12 AS STRING) AS agent_id,
  CAST(length(text) - length(replace(text, ' ', '')) + 1 AS BIGINT) AS tokens,
  CAST((length(text) - length(replace(text, ' ', '')) + 1) * 0.00002 AS DECIMAL(18,5)) AS cost_usd
FROM conversations WHERE role = 'assistant'
"""

# Thumbs on assistant messages.
VIEW_SQL["feedback"] = """
SELECT conv_id AS conversation_id, turn AS position, CASE WHEN length(text) % 3 = 0 THEN 'down' ELSE 'up' END AS value
FROM conversations WHERE role = 'assistant'
"""

# An assistant message opens a call; the message after it carries the output.
VIEW_SQL["thinking_events"] = """
SELECT conv_id AS conversation_id, turn AS seq, 'tool_call' AS kind, CAST(conv_id AS STRING) || ':' || CAST(turn AS STRING) AS call_id,
  'tool_' || CAST(length(text) % 5 AS STRING) AS name, md5(text) AS args, CAST(NULL AS STRING) AS output
FROM conversations WHERE role = 'assistant'
UNION ALL
SELECT conv_id, turn, 'tool_output', CAST(conv_id AS STRING) || ':' || CAST(turn - 1 AS STRING), CAST(NULL AS STRING), CAST(NULL AS STRING), md5(text)
FROM conversations WHERE role = 'user'
"""

VIEW_SQL["change_feed"] = """
SELECT user_id AS entity_key, event_id AS lsn, ts AS changed_at, event_type AS state,
  CASE WHEN event_id % 97 = 0 THEN 'delete' ELSE 'upsert' END AS change_type
FROM events
"""

# One chain per subscriber and day; errors are not part of the workflow.
VIEW_SQL["workflow_state"] = """
SELECT event_id, 'SUB-' || lpad(CAST(user_id + 1 AS STRING), 7, '0') AS subscriber_id, CAST(ts AS DATE) AS action_date, ts AS created_at,
  CASE event_type WHEN 'signup' THEN 'risk_trigger' WHEN 'view' THEN 'offer_recommended' WHEN 'click' THEN 'action_submitted' ELSE 'action_approved' END AS event_type
FROM events WHERE event_type <> 'error'
"""

# Ids are padded to a fixed width but never cut: past the width they just grow longer.
_PAD = re.compile(r"lpad\((CAST\(\w+(?:\.\w+)?(?: [+%] \d+)* AS STRING\)), (\d+), '0'\)")
VIEW_SQL = {name: _PAD.sub(r"lpad(\1, CAST(greatest(\2, length(\1)) AS INT), '0')", sql) for name, sql in VIEW_SQL.items()}

_SOURCE = re.compile(r"\b(FROM|JOIN)\s+(\w+)", re.IGNORECASE)


def subscriber_key(index: Column) -> Column:
    """The id of the subscriber with that index: padded, and longer than the width when the number is."""
    n = (index + 1).cast("string")
    return F.concat(F.lit("SUB-"), F.lpad(n, F.greatest(F.lit(7), F.length(n)), F.lit("0")))


_SCHEMAS: dict[str, tuple[int, T.StructType]] = {}


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A base table with the schema of its files, which is inferred again only after the file or folder has changed."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    changed = where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where).getModificationTime()
    known = _SCHEMAS.get(path)
    if known is None or known[0] != changed:
        known = _SCHEMAS[path] = changed, spark.read.parquet(path).schema
    return spark.read.schema(known[1]).parquet(path)


def bind_view(spark: SparkSession, name: str, resolve) -> DataFrame:
    """Plan one adapter statement over the DataFrames that ``resolve(name)`` returns."""
    text = VIEW_SQL[name]
    known = [s for s in dict.fromkeys(m.group(2) for m in _SOURCE.finditer(text))
             if s in BASE_TABLES or s in VIEW_SQL]
    bound = _SOURCE.sub(
        lambda m: f"{m.group(1)} {{{m.group(2)}}}" if m.group(2) in known else m.group(0), text)
    return spark.sql(bound, **{s: resolve(s) for s in known})
