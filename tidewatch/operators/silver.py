"""Per-subscriber rollups and the note classifier."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.text import note_class
from tidewatch.params import Params


def class_score(label: Column, p: Params) -> Column:
    return (F.when(label == "churn_signal", F.lit(p.score_churn_signal))
            .when(label == "at_risk", F.lit(p.score_at_risk))
            .when(label == "healthy", F.lit(p.score_healthy)))


def note_churn_flags(notes: DataFrame, p: Params,
                     classify: Callable[[Column], Column] = note_class) -> DataFrame:
    """Class and score of each distinct note.

    ``classify`` maps the note column to a class name; pass a pandas UDF to use
    a model.  It runs once per distinct text, after the shuffle of ``distinct``.
    """
    distinct = notes.select("agent_note_text").filter(F.col("agent_note_text").isNotNull()).distinct()
    labelled = distinct.withColumn("note_class", classify(F.col("agent_note_text")))
    return labelled.withColumn("churn_signal_score", class_score(F.col("note_class"), p))


def silver_tickets(tickets: DataFrame) -> DataFrame:
    is_open = F.col("closed_date").isNull()
    return tickets.groupBy("subscriber_id").agg(
        F.count_if(is_open).cast("int").alias("open_ticket_count"),
        F.bool_or(is_open & (F.col("ticket_type") == "outage")).alias("has_open_outage"),
        F.bool_or(is_open & (F.col("ticket_type") == "billing")).alias("has_open_billing"),
        F.max_by("ticket_type", F.struct("opened_date", "ticket_id")).alias("latest_ticket_type"))


def silver_billing(billing: DataFrame, p: Params) -> DataFrame:
    """Dispute rollup; "recent" means billed in this or the previous month of ``as_of``."""
    recent = F.col("disputed") & (F.col("bill_month") >= F.lit(p.recent_bill_month))
    when = F.when(F.col("dispute_reason").isNotNull(), F.struct("bill_month", "bill_id"))
    return billing.groupBy("subscriber_id").agg(
        F.bool_or(recent).alias("has_recent_dispute"),
        F.max_by("dispute_reason", when).alias("last_dispute_reason"))


#: Parts a note's rows are dealt into where scores are joined by note: a few texts stand on most rows.
NOTE_PARTS = 64


def with_note_score(rows: DataFrame, p: Params, flags: DataFrame | None = None) -> DataFrame:
    """Rows with the score of their note.

    The keyword rule is evaluated in the row.  Scores of a costlier classifier, (agent_note_text, churn_signal_score), are
    joined by note and part, so that neither a frequent note nor the missing one meets in one task.
    """
    if flags is None:
        note = F.col("agent_note_text")
        return rows.withColumn("churn_signal_score", F.when(note.isNotNull(), class_score(note_class(note), p)))
    parts = flags.select("agent_note_text", "churn_signal_score", F.explode(F.sequence(F.lit(0), F.lit(NOTE_PARTS - 1))).alias("part__"))
    dealt = rows.withColumn("part__", F.pmod(F.xxhash64("subscriber_id", "snapshot_date"), F.lit(NOTE_PARTS)).cast("int"))
    return dealt.join(parts, ["agent_note_text", "part__"], "left").drop("part__")


def silver_risk(snapshots: DataFrame, subscribers: DataFrame, p: Params, flags: DataFrame | None = None) -> DataFrame:
    """Every snapshot with its subscriber and note score; write it partitioned by date."""
    subs = subscribers.select("subscriber_id", "plan_type", "tenure_months", "monthly_arpu_usd",
                              "service_node_id", "home_metro")
    return with_note_score(snapshots.join(subs, "subscriber_id", "inner"), p, flags)


def silver_retention(history: DataFrame, subscribers: DataFrame) -> DataFrame:
    subs = subscribers.select("subscriber_id", "plan_type", "tenure_months", "home_metro")
    return history.join(subs, "subscriber_id", "left")


def usage_daily(usage: DataFrame) -> DataFrame:
    """One row per subscriber and day; raw usage is a bag."""
    return usage.groupBy("subscriber_id", "usage_date").agg(
        F.sum("data_gb").alias("data_gb"), F.sum("voice_min").alias("voice_min"),
        F.sum("stream_hours").alias("stream_hours"), F.count(F.lit(1)).alias("n_rows"))


def usage_sparkline(daily: DataFrame, p: Params) -> DataFrame:
    """Recent daily data volume per subscriber as an ordered array.

    An array holds at most ``sparkline_days`` entries: one per day of the window.
    """
    recent = daily.filter((F.col("usage_date") > F.date_sub(F.lit(p.as_of), p.sparkline_days))
                          & (F.col("usage_date") <= F.lit(p.as_of)))
    return recent.groupBy("subscriber_id").agg(
        F.sort_array(F.collect_list(F.struct("usage_date", "data_gb"))).alias("series"))
