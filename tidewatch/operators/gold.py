"""Current position, at-risk book and offer ranking."""

from __future__ import annotations

from dataclasses import replace
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import rules
from tidewatch.operators.silver import with_note_score
from tidewatch.operators.windows import top_per_key
from tidewatch.params import Params

SNAPSHOT_COLS = ("snapshot_date", "churn_risk_score", "churn_reason", "agent_note_text")


def current_snapshot(snapshots: DataFrame, p: Params) -> DataFrame:
    """Latest snapshot per subscriber up to ``as_of``.

    ``max_by`` combines map-side, so a hot subscriber ships one row per task.
    """
    latest = F.max_by(F.struct(*SNAPSHOT_COLS), F.col("snapshot_date")).alias("s")
    known = snapshots.filter(F.col("snapshot_date") <= F.lit(p.as_of))
    return (known.groupBy("subscriber_id").agg(latest).select("subscriber_id", "s.*"))


def subscriber_position(current: DataFrame, subscribers: DataFrame, tickets: DataFrame,
                        billing: DataFrame, p: Params, flags: DataFrame | None = None) -> DataFrame:
    """One row per subscriber.

    All rollups are already grouped by subscriber, so their joins reuse that
    partitioning; only the subscriber master is shuffled for them.  The note
    score is the keyword rule, evaluated in the row; a table of scores from a
    costlier classifier is joined instead when one is given.
    """
    joined = (current.join(subscribers, "subscriber_id", "inner")
              .join(tickets, "subscriber_id", "left")
              .join(billing, "subscriber_id", "left"))
    joined = with_note_score(joined, p, flags)
    open_tickets = F.coalesce("open_ticket_count", F.lit(0))
    no = F.lit(False)
    return joined.select(
        "subscriber_id", "sub_display_name", "plan_type", "tenure_months", "monthly_arpu_usd",
        "service_node_id", "home_metro", "sub_lat", "sub_lng", "service_summary", "snapshot_date",
        "churn_risk_score", "churn_reason", open_tickets.alias("open_ticket_count"),
        F.coalesce("has_open_outage", no).alias("has_open_outage"),
        F.coalesce("has_open_billing", no).alias("has_open_billing"),
        F.coalesce("has_recent_dispute", no).alias("has_recent_dispute"),
        "churn_signal_score",
        rules.clv_at_risk(F.col("monthly_arpu_usd"), F.col("churn_risk_score"), p).alias("clv_at_risk_usd"),
        rules.risk_band(F.col("churn_risk_score"), open_tickets, p).alias("risk_band"))


def candidate_offer(offers: DataFrame) -> DataFrame:
    """The catalog entry to try for each offer type: segment ``all`` first, then lowest id."""
    rank = F.struct(F.when(F.col("segment") == "all", 0).otherwise(1), F.col("offer_id"))
    return (offers.filter("is_active").groupBy("offer_type")
            .agg(F.min_by("offer_id", rank).alias("candidate_offer_id")))


def asof_event(book: DataFrame, events: DataFrame, p: Params) -> DataFrame:
    """Link each service-reason row to the latest event of its node in the lookback window.

    The lookup runs on distinct (node, date) pairs against one event per node
    and day, so a node that holds a third of all subscribers adds one pair, not
    a third of the rows.  Dates are cut into buckets as long as the lookback;
    an event can only answer dates of its own bucket or the next one, which
    turns the range condition into an equi join.
    """
    days = p.event_lookback_days

    def bucket(d):
        return F.floor(F.datediff(d, F.lit("1970-01-01").cast("date")) / days)

    daily = (events.groupBy("node_id", "event_date")
             .agg(F.max_by(F.struct("event_id", "event_type"), F.col("event_id")).alias("e"))
             .withColumn("b", F.explode(F.array(bucket("event_date"), bucket("event_date") + 1))))
    asked = (book.filter(F.col("churn_reason") == "service")
             .select(F.col("service_node_id").alias("node_id"), "snapshot_date").distinct()
             .withColumn("b", bucket("snapshot_date")))
    found = (asked.join(daily, ["node_id", "b"])
             .filter((F.col("event_date") <= F.col("snapshot_date"))
                     & (F.col("event_date") >= F.date_sub("snapshot_date", days)))
             .groupBy(F.col("node_id").alias("service_node_id"), "snapshot_date")
             .agg(F.max_by(F.struct("event_date", "e"), F.col("event_date")).alias("l"))
             .select("service_node_id", "snapshot_date", F.lit("service").alias("churn_reason"),
                     F.col("l.e.event_id").alias("linked_event_id"),
                     F.col("l.e.event_type").alias("linked_event_type"),
                     F.col("l.event_date").alias("linked_event_date")))
    return book.join(found, ["service_node_id", "snapshot_date", "churn_reason"], "left")


def at_risk_book(position: DataFrame) -> DataFrame:
    return position.filter(F.col("risk_band").isin("critical", "elevated", "watch"))


def open_atrisk(book: DataFrame, events: DataFrame, offers: DataFrame, p: Params) -> DataFrame:
    """At-risk rows with linked event and candidate offer.

    The book is read twice (dates to look up, rows to link), so pass a written
    or pinned table.
    """
    linked = asof_event(book, events, p)
    by_type = candidate_offer(offers)
    return (linked.withColumn("offer_type", rules.offer_for_reason(F.col("churn_reason")))
            .join(by_type, "offer_type", "left").drop("offer_type"))


def recommendations(book: DataFrame, p: Params) -> DataFrame:
    """Ranked plays of every at-risk subscriber, computed inside the row."""
    plays = rules.offer_plays(F.col("clv_at_risk_usd"), F.col("monthly_arpu_usd"), F.col("churn_reason"), p)
    ranked = book.select("subscriber_id", "churn_reason", plays.alias("plays"))
    best = F.col("plays")[0]
    return ranked.select(
        "subscriber_id", best["offerType"].alias("recommended_offer"),
        best["predictedRetainedClvUsd"].alias("predicted_retained_clv_usd"),
        best["predictedNetValueUsd"].alias("predicted_net_value_usd"),
        (best["predictedNetValueUsd"] > 0).alias("is_profitable"),
        rules.ranking_json(F.col("plays")).alias("offer_ranking"),
        F.lit(p.as_of).alias("scored_on"))


def offer_rank(book: DataFrame, p: Params) -> DataFrame:
    """One row per subscriber and play with its rank."""
    plays = rules.offer_plays(F.col("clv_at_risk_usd"), F.col("monthly_arpu_usd"), F.col("churn_reason"), p)
    return (book.select("subscriber_id", F.posexplode(plays).alias("pos", "o"))
            .select("subscriber_id", (F.col("pos") + 1).alias("offer_rank"),
                    F.col("o.offerType").alias("offer_type"), F.col("o.costUsd").alias("cost_usd"),
                    F.col("o.predictedRetainedClvUsd").alias("retained_clv_usd"),
                    F.col("o.predictedNetValueUsd").alias("net_value_usd")))


def offer_what_if(book: DataFrame, p: Params, *, offer_type: str, hit: Decimal, cost: Decimal) -> DataFrame:
    """Re-score one play with another probability and cost, against the recommended one."""
    clv = F.col("clv_at_risk_usd")
    now = rules.offer_plays(clv, F.col("monthly_arpu_usd"), F.col("churn_reason"), p)[0]
    retained = rules.money(clv * rules.dec(hit))
    net = rules.money(retained - rules.dec(cost))
    return (book.select("subscriber_id", now.alias("now"), retained.alias("retained"), net.alias("net"))
            .select("subscriber_id", F.lit(offer_type).alias("what_if_offer"),
                    F.col("now.offerType").alias("recommended_offer"),
                    F.col("retained").alias("what_if_retained_usd"), F.col("net").alias("what_if_net_usd"),
                    (F.col("net") - F.col("now.predictedNetValueUsd")).alias("delta_net_usd"),
                    (F.col("net") > F.col("now.predictedNetValueUsd")).alias("beats_recommended")))


def retention_outcomes(silver: DataFrame) -> DataFrame:
    return silver.select("retention_id", "subscriber_id", "offer_type", "churn_reason", "monthly_arpu_usd",
                         "offer_cost_usd", "retained", "retained_clv_usd")


# The columns of the ranked view.
VIEW_COLS = ("subscriber_id", "plan_type", "tenure_months", "monthly_arpu_usd", "service_node_id", "home_metro",
             "churn_risk_score", "churn_reason", "open_ticket_count", "has_open_outage", "clv_at_risk_usd", "risk_band",
             "service_summary", "recommended_offer", "predicted_retained_clv_usd")


def with_ranked_offer(position: DataFrame, p: Params) -> DataFrame:
    """Position with the heuristic offer of its at-risk rows, computed in the row.

    Same rows as joining the recommendation table, without a join.
    """
    plays = rules.offer_plays(F.col("clv_at_risk_usd"), F.col("monthly_arpu_usd"), F.col("churn_reason"), p)
    at_risk = F.col("risk_band").isin("critical", "elevated", "watch")
    best = F.when(at_risk, plays[0])
    return position.withColumn("best__", best).select(
        *position.columns, F.col("best__.offerType").alias("recommended_offer"),
        F.col("best__.predictedRetainedClvUsd").alias("predicted_retained_clv_usd"),
        F.col("best__.predictedNetValueUsd").alias("predicted_net_value_usd"))


def with_offer(position: DataFrame, recs: DataFrame) -> DataFrame:
    return position.join(recs, "subscriber_id", "left")


def atrisk_view(with_offers: DataFrame, limit: int = 50) -> DataFrame:
    """Ranked view: critical and elevated subscribers with their offer, by CLV at risk."""
    red = with_offers.filter(F.col("risk_band").isin("critical", "elevated"))
    return (red.select(*VIEW_COLS)
            .orderBy(F.desc("clv_at_risk_usd"), "subscriber_id").limit(limit))


def worst_by_reason(position: DataFrame, k: int) -> DataFrame:
    """Drill-down: the k worst subscribers of every churn reason."""
    red = position.filter(F.col("risk_band").isin("critical", "elevated"))
    return top_per_key(red, ["churn_reason"], [F.desc("clv_at_risk_usd"), F.asc("subscriber_id")], k)


def changed_rows(before: DataFrame, after: DataFrame) -> DataFrame:
    """Subscribers whose band, score or CLV differs between two refreshes.

    A subscriber that appears for the first time is not a change.
    """
    cols = ("risk_band", "churn_risk_score", "clv_at_risk_usd")
    old = before.select("subscriber_id", *[F.col(c).alias(f"old_{c}") for c in cols])
    new = after.select("subscriber_id", *cols)
    differs = F.lit(False)
    for c in cols:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"old_{c}"))
    return (old.join(new, "subscriber_id", "full")
            .filter(F.col("old_risk_band").isNotNull() & differs))


def at(p: Params, as_of) -> Params:
    return replace(p, as_of=as_of)
