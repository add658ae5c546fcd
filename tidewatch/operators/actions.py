"""Write-back: recorded actions, approvals, audit trails, tiered bulk decisions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import rules, text
from tidewatch.operators.returns import filtered, searched
from tidewatch.operators.windows import running_totals
from tidewatch.params import ACTION_OUTCOMES, ACTION_TYPES, OFFER_TYPES, Params

APPLIED = ("approved", "retained")
RED = ("critical", "elevated")


def latest_action(actions: DataFrame) -> DataFrame:
    """Newest action per subscriber, combined map-side."""
    cols = ("action_id", "action_type", "offer_type", "outcome", "agent_id", "created_at")
    return (actions.groupBy("subscriber_id")
            .agg(F.max_by(F.struct(*cols), F.struct("created_at", "action_id")).alias("a"))
            .select("subscriber_id", "a.*"))


def live_state(position: DataFrame, actions: DataFrame) -> DataFrame:
    """Position with its latest action; a subscriber with an applied offer is saved."""
    latest = latest_action(actions).select(
        "subscriber_id", F.col("action_id").alias("last_action_id"),
        F.col("offer_type").alias("last_offer"), F.col("outcome").alias("last_outcome"))
    return position.join(latest, "subscriber_id", "left").withColumn(
        "offer_applied", F.coalesce(F.col("last_outcome").isin(*APPLIED), F.lit(False)))


# Tabs and sort keys of the care queue.
TABS = {"all": None, "critical": "critical", "elevated": "elevated", "watch": "watch", "applied": None}
CARE_SORTS = {"clv": "clv_at_risk_usd", "risk": "churn_risk_score", "tenure": "tenure_months"}


def care_queue(state: DataFrame, tab: str = "all", search: str | None = None, sort: str = "clv",
               limit: int | None = None, **filters) -> DataFrame:
    """The at-risk work list: tab, optional filters and search, one of three orders."""
    rows = state.filter(F.col("risk_band").isin("critical", "elevated", "watch"))
    if tab == "applied":
        rows = rows.filter("offer_applied")
    elif TABS[tab]:
        rows = rows.filter(F.col("risk_band") == TABS[tab])
    rows = searched(filtered(rows, **filters), search, ("subscriber_id", "plan_type", "home_metro"))
    rows = rows.orderBy(F.desc(CARE_SORTS[sort]), "subscriber_id")
    return rows.limit(limit) if limit else rows


def care_kpis(state: DataFrame) -> DataFrame:
    """Queue counters before and net of applied offers."""
    red = F.col("risk_band").isin(*RED)
    open_red = red & ~F.col("offer_applied")
    zero = F.lit(0).cast(rules.MONEY)
    return state.agg(
        F.sum("clv_at_risk_usd").alias("clv_at_risk_usd"),
        F.sum(F.when(F.col("offer_applied"), zero).otherwise(F.col("clv_at_risk_usd"))).alias("clv_open_usd"),
        F.sum("open_ticket_count").alias("open_tickets"), F.count_if(red).alias("atrisk_count"),
        F.count_if(open_red).alias("atrisk_open_count"), F.count_if(F.col("offer_applied")).alias("applied_count"))


def live_kpi(position: DataFrame, actions: DataFrame) -> DataFrame:
    """Per day: actions written, at-risk subscribers saved for the first time, CLV taken off the book."""
    daily = actions.groupBy(F.col("created_at").cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("n_actions"), F.count_if(F.col("outcome").isin(*APPLIED)).alias("n_applied"))
    first = (actions.filter(F.col("outcome").isin(*APPLIED)).groupBy("subscriber_id")
             .agg(F.min("created_at").cast("date").alias("day")))
    red = position.filter(F.col("risk_band").isin(*RED)).select("subscriber_id", "clv_at_risk_usd")
    saved = first.join(red, "subscriber_id").groupBy("day").agg(
        F.count(F.lit(1)).alias("newly_saved"), F.sum("clv_at_risk_usd").alias("clv_drop_usd"))
    return daily.join(saved, "day", "left").fillna(0, ["newly_saved"]).withColumn(
        "clv_drop_usd", F.coalesce("clv_drop_usd", F.lit(0)))


def record_actions(requests: DataFrame, by: str, at: Column, *, status: str = "approved",
                   tool: str = "record_action") -> DataFrame:
    """New action rows with a content key and their first audit entry.

    The key is a hash of subscriber, offer and time, so a retried write gives
    the same ids.
    """
    entry = rules.audit_entry(at, F.lit(by), F.lit(status), F.lit("Retention action recorded"), F.lit(tool))
    return requests.select(
        F.sha2(F.concat_ws("|", "subscriber_id", "offer_type", at), 256).alias("id"),
        "subscriber_id", "offer_type", "offer_id", "drafted_summary", "predicted_retained_clv_usd",
        F.lit(status).alias("status"), F.lit(by).alias("approved_by"),
        F.array(entry).alias("audit_trail"), at.alias("created_at"),
        (F.lit(None).cast("string") if status == "pending" else at).alias("decided_at"))


def append_actions(log_path: str, rows: DataFrame) -> None:
    rows.write.mode("append").parquet(log_path)


def override_offer(requests: DataFrame, by: str, at: Column) -> DataFrame:
    """The lead chose another offer than the recommended one."""
    return record_actions(requests, by, at, status="overridden", tool="override_offer")


def append_audit(df: DataFrame, entry: Column, when: Column | None = None, col: str = "audit_trail") -> DataFrame:
    longer = F.concat(F.coalesce(F.col(col), F.array().cast(rules.AUDIT_TRAIL)), F.array(entry))
    return df.withColumn(col, longer if when is None else F.when(when, longer).otherwise(F.col(col)))


def _one_request(requests: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Repeated requests for a row count once: the first by ``request_id`` wins."""
    return requests.groupBy(key).agg(
        F.min_by(F.struct(*cols), F.col("request_id")).alias("r"), F.count(F.lit(1)).alias("n_requests")
    ).select(key, "r.*", "n_requests")


def approve_actions(actions: DataFrame, requests: DataFrame) -> DataFrame:
    """The action table after approval: only rows still pending change."""
    asked = _one_request(requests, "action_id", ["approver"])
    hit = F.col("approver").isNotNull() & (F.col("outcome") == "pending")
    return (actions.join(asked.select("action_id", "approver"), "action_id", "left")
            .withColumn("was_updated", hit)
            .withColumn("agent_id", F.when(hit, F.col("approver")).otherwise(F.col("agent_id")))
            .withColumn("outcome", F.when(hit, F.lit("approved")).otherwise(F.col("outcome")))
            .drop("approver"))


def approval_report(actions: DataFrame, requests: DataFrame) -> DataFrame:
    """What became of each request: approved, not pending, or not found."""
    asked = _one_request(requests, "action_id", ["approver"])
    return (asked.join(actions.select("action_id", "outcome"), "action_id", "left")
            .select("action_id", "approver", "n_requests",
                    F.when(F.col("outcome").isNull(), "not_found").when(F.col("outcome") == "pending", "approved")
                    .otherwise("not_pending").alias("result")))


def decide_rows(rows: DataFrame, decisions: DataFrame, at: Column) -> DataFrame:
    """Apply approve / reject / escalate to pending returns and write the audit entry."""
    asked = _one_request(decisions, "return_id", ["decision", "by"])
    valid = F.col("decision").isin("approved", "rejected", "escalated") & (F.col("status") == "pending")
    hit = F.coalesce(valid, F.lit(False))
    entry = rules.audit_entry(at, F.col("by"), F.col("decision"), F.lit(None).cast("string"), F.lit("decide"))
    return (rows.join(asked, "return_id", "inner")
            .select("return_id", F.when(hit, F.col("decision")).otherwise(F.col("status")).alias("status"),
                    hit.alias("was_updated"),
                    F.when(hit, F.array(entry)).otherwise(F.array().cast(rules.AUDIT_TRAIL)).alias("audit_trail")))


def priority(actions: DataFrame) -> DataFrame:
    """Triage order of the action log."""
    return (actions.select("action_id", "subscriber_id", "outcome", "created_at",
                           rules.priority_score(F.col("outcome")).alias("priority_score"))
            .orderBy(F.desc_nulls_last("priority_score"), F.desc("created_at"), F.desc("action_id")))


def recent_actions(log: DataFrame, notes: DataFrame, k: int = 20) -> DataFrame:
    """The newest k actions of a log without texts, then their notes, (note_doc, notes)."""
    newest = log.orderBy(F.desc("created_at"), F.desc("action_id")).limit(k)
    return (newest.join(notes, "note_doc", "left").orderBy(F.desc("created_at"), F.desc("action_id"))
            .select("action_id", "subscriber_id", "action_type", "offer_type", "outcome", "agent_id", "created_at",
                    text.ellipsis(F.col("notes"), 60, "...").alias("notes_preview")))


def enum_violations(actions: DataFrame) -> DataFrame:
    """Quarantine: one row per value outside its enumeration (a NULL offer is allowed)."""
    checks = (("action_type", ACTION_TYPES, False), ("outcome", ACTION_OUTCOMES, False),
              ("offer_type", OFFER_TYPES, True))
    found = []
    for col, allowed, null_ok in checks:
        bad = ~F.col(col).isin(*allowed)
        bad = F.coalesce(bad, F.lit(not null_ok))
        found.append(F.when(bad, F.struct(F.lit(col).alias("field"), F.col(col).alias("value"))))
    return (actions.select("action_id", F.explode(F.array_compact(F.array(*found))).alias("v"))
            .select("action_id", "v.field", "v.value"))


# ---- tiered bulk decision ----

@dataclass(frozen=True)
class TierOffer:
    percent_off: int
    subject: str
    body: str


TIER_OFFERS = {
    "premium": TierOffer(20, "We are sorry, {firstname}", "Dear {firstname} {lastname}, use {coupon_code} for 20% off after {product_name}."),
    "standard": TierOffer(5, "About your return", "Hello {firstname}, use {coupon_code} for 5% off after {product_name}."),
}


def coupon_code(percent_off: Column, reason: Column) -> Column:
    """A pure function of its inputs."""
    return F.concat(F.lit("SAVE"), percent_off.cast("string"), F.lit("-"),
                    F.upper(F.substring(F.md5(F.concat_ws("|", reason, percent_off.cast("string"))), 1, 6)))


def _by_tier(tier: Column, offers: dict[str, TierOffer], attr: str) -> Column:
    # A row without a prediction gets the standard offer.
    return F.when(tier == "premium", F.lit(getattr(offers["premium"], attr))).otherwise(
        F.lit(getattr(offers["standard"], attr)))


def bulk_tiered_action(current: DataFrame, customers: DataFrame, where: Column, by: str, at: Column,
                       offers: dict[str, TierOffer] = TIER_OFFERS) -> DataFrame:
    """Approve every pending row that meets the filter, with the offer of its tier.

    Filter, tier choice, message and audit are one plan; no list of ids ever
    leaves Spark.
    """
    pending = current.filter(where & (F.col("status") == "pending"))
    tier, label = F.col("final_tier"), F.col("premium_status_labeled")
    first, last = text.name_parts(F.col("customer_name"))
    pct = _by_tier(tier, offers, "percent_off")
    code = coupon_code(pct, F.col("facility"))
    values = {"firstname": first, "lastname": last, "product_name": F.col("product_name"), "coupon_code": code}
    origin = (F.when(rules.is_labeled_premium(tier, label), "premium, tagged by hand")
              .when(rules.is_hidden_premium(tier, label), "premium, hidden").otherwise("standard"))
    email = F.struct(at.alias("at"), F.lit("outgoing").alias("direction"),
                     text.fill_template(_by_tier(tier, offers, "subject"), values).alias("subject"),
                     text.fill_template(_by_tier(tier, offers, "body"), values).alias("body"))
    audits = F.array(
        rules.audit_entry(at, F.lit(by), F.lit("email_sent"), origin, F.lit("bulk")),
        rules.audit_entry(at, F.lit(by), F.lit("approved"), origin, F.lit("bulk")))
    return (pending.join(customers.select("customer_id", "customer_name"), "customer_id", "left")
            .select("return_id", "lot_id", "customer_id", "final_tier", "premium_status_labeled", "refund_amount_usd",
                    pct.alias("coupon_pct"), code.alias("coupon_code"), F.lit("approved").alias("status"),
                    origin.alias("origin"), F.array(email).alias("emails"), audits.alias("audit_trail")))


def bulk_action_summary(updated: DataFrame, attempted: DataFrame) -> DataFrame:
    """Counts taken from the rows that changed; attempted rows that did not are skipped."""
    tier, label = F.col("final_tier"), F.col("premium_status_labeled")
    marked = attempted.select("return_id").join(
        updated.select("return_id", "final_tier", "premium_status_labeled", "refund_amount_usd",
                       F.lit(True).alias("done")), "return_id", "left")
    done = F.coalesce("done", F.lit(False))
    premium = F.coalesce(tier == "premium", F.lit(False))
    return marked.agg(
        F.count(F.lit(1)).alias("attempted_count"), F.count_if(done).alias("approved_count"),
        F.count_if(done & premium).alias("premium_email_count"),
        F.count_if(done & ~premium).alias("standard_email_count"),
        F.count_if(done & rules.is_labeled_premium(tier, label)).alias("premium_labeled_count"),
        F.count_if(done & rules.is_hidden_premium(tier, label)).alias("premium_predicted_hidden_count"),
        F.coalesce(F.sum("refund_amount_usd"), F.lit(0)).alias("total_refund_usd"),
        F.count_if(~done).alias("skipped_count"))


def skipped_rows(updated: DataFrame, attempted: DataFrame) -> DataFrame:
    return attempted.select("return_id").join(updated.select("return_id"), "return_id", "left_anti")


def render_messages(returns: DataFrame, customers: DataFrame, offers: dict[str, TierOffer] = TIER_OFFERS) -> DataFrame:
    first, last = text.name_parts(F.col("customer_name"))
    tier = F.col("final_tier")
    pct = _by_tier(tier, offers, "percent_off")
    values = {"firstname": first, "lastname": last, "product_name": F.col("product_name"),
              "coupon_code": coupon_code(pct, F.col("facility"))}
    return returns.join(customers.select("customer_id", "customer_name"), "customer_id").select(
        "return_id", text.fill_template(_by_tier(tier, offers, "subject"), values).alias("subject"),
        text.fill_template(_by_tier(tier, offers, "body"), values).alias("body"))


# ---- feeds ----

def _items() -> tuple[Column, Column]:
    """Mails and audit entries of a row, brought to one shape."""
    none = F.lit(None).cast("string")
    mails = F.transform("emails", lambda e: F.struct(
        e["at"].alias("at"), F.lit("email").alias("kind"), e["direction"].alias("action"),
        e["subject"].alias("detail"), none.alias("by")))
    audits = F.transform("audit_trail", lambda a: F.struct(
        a["at"].alias("at"), F.lit("audit").alias("kind"), a["action"].alias("action"),
        a["notes"].alias("detail"), a["by"].alias("by")))
    return mails, audits


def activity_feed(rows: DataFrame, k: int = 20) -> DataFrame:
    """Newest mails and audit entries over all rows; the limit is the feed's length."""
    mails, audits = _items()
    return (rows.select("return_id", F.explode(F.concat(mails, audits)).alias("i")).select("return_id", "i.*")
            .orderBy(F.desc("at"), "return_id", "kind", "action").limit(k))


def entity_timeline(rows: DataFrame) -> DataFrame:
    """Timeline of every row, newest first; ordered inside the row, without a shuffle."""
    mails, audits = _items()
    ordered = F.reverse(F.sort_array(F.concat(mails, audits)))
    return rows.select("return_id", F.posexplode(ordered).alias("position", "i")).select("return_id", "position", "i.*")


# ---- memos ----

def decision_memos(scored: DataFrame, on: str) -> DataFrame:
    """One rendered memo per at-risk subscriber, with open lines for the decision."""
    na = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("N/A"))
    line = lambda label, value: F.concat(F.lit(f"- **{label}**: "), value)
    amount = lambda c: F.concat(F.lit("$"), F.format_number(F.coalesce(F.col(c), F.lit(0)).cast(rules.MONEY), 2))
    # The headings and labels of the memo.
    memo = F.concat_ws(
        "\n", F.lit("# Retention Decision Memo\n"), F.concat(F.lit("**Subscriber**: "), na("subscriber_id")), F.lit(f"**Date**: {on}"),
        F.lit("\n## Risk Assessment"), line("Risk Score", na("churn_risk_score")), line("Risk Band", na("risk_band")),
        line("Churn Reason", na("churn_reason")), line("CLV at Risk", amount("clv_at_risk_usd")),
        F.lit("\n## Subscriber Profile"), line("Plan", na("plan_type")), line("Tenure", F.concat(na("tenure_months"), F.lit(" months"))),
        line("ARPU", F.concat(amount("monthly_arpu_usd"), F.lit("/mo"))), line("Node", na("service_node_id")), line("Metro", na("home_metro")),
        F.lit("\n## Service Summary"), na("service_summary"),
        F.lit("\n## Recommendation"), line("Offer", na("recommended_offer")),
        line("Predicted Retained CLV", amount("predicted_retained_clv_usd")), line("Net Value", amount("predicted_net_value_usd")),
        F.lit("\n## Decision"), F.lit("- [ ] Approve recommended offer"), F.lit("- [ ] Escalate to manager"), F.lit("- [ ] Custom offer: _______________"),
        F.lit("\n**Approver**: _______________"), F.lit("**Signature**: _______________"))
    book = scored.filter(F.col("risk_band").isin("critical", "elevated", "watch"))
    return book.select("subscriber_id", memo.alias("memo"))


# ---- model spend ----

#: Parts an agent's rows are dealt into.
AGENT_PARTS = 64


def spend_attribution(calls: DataFrame, actions: DataFrame) -> DataFrame:
    """Spread each agent's model cost over the subscribers the agent acted on.

    Both sides are aggregated before the join: one row per agent against one
    row per (agent, subscriber).  Few agents hold all rows, so each agent's rows
    are dealt into parts for the totals and the join.  Shares are whole
    hundred-millionths of a dollar, so the sums do not depend on row order.
    """
    parts = F.explode(F.sequence(F.lit(0), F.lit(AGENT_PARTS - 1))).alias("part")
    spend = calls.groupBy("agent_id").agg((F.sum("cost_usd") * 100_000_000).cast("bigint").alias("agent_cost"))
    totals = actions.groupBy("agent_id").agg(F.count(F.lit(1)).alias("agent_actions"))
    pairs = (actions.groupBy("agent_id", "subscriber_id").agg(F.count(F.lit(1)).alias("n"))
             .withColumn("part", F.pmod(F.xxhash64("subscriber_id"), F.lit(AGENT_PARTS)).cast("int")))
    share = F.expr("agent_cost * n div agent_actions")
    return (pairs.join(spend.join(totals, "agent_id").select("*", parts), ["agent_id", "part"])
            .groupBy("subscriber_id").agg(F.sum("n").alias("actions"),
                                          (F.sum(share) / 100_000_000).alias("attributed_cost_usd")))


def spend_cap(calls: DataFrame, cap: Column, p: Params) -> DataFrame:
    """Running cost per conversation and the first call that breaks the cap."""
    run = running_totals(calls, ["conversation_id"], "call_seq", {"running_cost_usd": "cost_usd"}, p.hot_key_rows)
    over = F.col("running_cost_usd") > cap
    first = over & (F.col("running_cost_usd") - F.col("cost_usd") <= cap)
    return run.select("conversation_id", "call_seq", "tokens", "cost_usd", "running_cost_usd",
                      over.alias("over_cap"), first.alias("first_breach"))
