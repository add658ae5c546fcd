"""Rebuild of all silver and gold tables, each written once and read by its consumers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidewatch.operators import gold, metrics, silver
from tidewatch.plans.lake import Lake


def _save(df: DataFrame, root: str, name: str, partition_by: tuple[str, ...] = ()) -> tuple[DataFrame, int]:
    seen = Observation(f"rows_{name}")
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").partitionBy(*partition_by).parquet(f"{root}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{root}/{name}"), seen.get["n"]


def rebuild(lake: Lake, root: str) -> dict[str, int]:
    """Write every table under ``root`` in dependency order and return the row counts.

    A table is computed from the written tables before it, so the hub (the
    subscriber position) is computed once however many tables read it.
    """
    p, counts, done = lake.p, {}, {}

    def table(name: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
        done[name], counts[name] = _save(df, root, name, partition_by)
        return done[name]

    table("note_churn_flags", lake.flags)
    tickets = table("silver_tickets", lake.tickets_rollup)
    billing = table("silver_billing", lake.billing_rollup)
    table("silver_risk", silver.silver_risk(lake["risk_snapshots"], lake["subscribers"], p), ("snapshot_date",))
    history = table("silver_retention", silver.silver_retention(lake["retention_history"], lake["subscribers"]))
    position = table("gold_subscriber_position", gold.subscriber_position(
        gold.current_snapshot(lake["risk_snapshots"], p), lake["subscribers"], tickets, billing, p))
    book = table("gold_open_atrisk", gold.open_atrisk(gold.at_risk_book(position), lake["network_events"], lake["offers"], p))
    table("gold_retention_outcomes", gold.retention_outcomes(history))
    table("gold_retention_recommendations", gold.recommendations(book, p))
    table("metric_cube", metrics.metric_cube(position))
    return counts
