"""Streaming twins of the change-history queries, run to completion over the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

import tidewatch.plans.service  # noqa: F401  (its SQL is shared)
from tidewatch.plans.registry import SQL, query
from tidewatch.session import shared_dir
from tidewatch.sources.adapters import subscriber_key
from tidewatch.streaming import batches, cdc, chains, kpi


def _roots(lake, name: str) -> tuple[str, str]:
    root = f"{shared_dir(lake.spark)}/{name}-{uuid.uuid4().hex}"
    return f"{root}/out", f"{root}/checkpoint"


def _events(lake):
    # A pattern, because a file source accepts a single file only through one.
    return batches.file_stream(lake.spark, f"{lake.sf_dir}/events.parque[t]", lake["events"].schema)


def _feed(events):
    return events.select(
        F.col("user_id").alias("entity_key"), F.col("event_id").alias("lsn"), F.col("ts").alias("changed_at"),
        F.col("event_type").alias("state"), F.when(F.col("event_id") % 97 == 0, "delete").otherwise("upsert").alias("change_type"))


@query("scd2_stream", SQL["scd2_history"])
def _(lake):
    root, checkpoint = _roots(lake, "scd2")
    cdc.stream_history(_feed(_events(lake)), root, checkpoint, lake.p)
    return cdc.read_history(lake.spark, root, lake.p)


@query("latest_state_stream", SQL["cdc_latest_state"])
def _(lake):
    root, checkpoint = _roots(lake, "latest")
    cdc.stream_history(_feed(_events(lake)), root, checkpoint, lake.p)
    return cdc.read_latest(lake.spark, root)


@query("live_kpi_stream", SQL["live_kpi"])
def _(lake):
    root, checkpoint = _roots(lake, "kpi")
    e, kind = F.col("event_id"), F.col("event_type")
    outcome = (F.when(kind == "signup", "pending").when(kind == "purchase", "approved")
               .when(kind == "click", "retained").otherwise("escalated"))
    actions = _events(lake).filter(e % 5 == 0).select(
        e.alias("action_id"), subscriber_key(F.col("user_id")).alias("subscriber_id"),
        outcome.alias("outcome"), F.col("ts").alias("created_at"))
    kpi.stream_kpi(actions, root, checkpoint)
    return kpi.read_kpi(lake.spark, root, lake.position)


@query("decision_chain_stream", SQL["decision_chain"])
def _(lake):
    root, checkpoint = _roots(lake, "chains")
    kind = F.col("event_type")
    step = (F.when(kind == "signup", "risk_trigger").when(kind == "view", "offer_recommended")
            .when(kind == "click", "action_submitted").otherwise("action_approved"))
    log = _events(lake).filter(kind != "error").select(
        "event_id", subscriber_key(F.col("user_id")).alias("subscriber_id"),
        F.col("ts").cast("date").alias("action_date"), F.col("ts").alias("created_at"), step.alias("event_type"))
    chains.stream_chains(log, root, checkpoint, lake.p.chain_keep_days)
    return chains.read_chains(lake.spark, root)

