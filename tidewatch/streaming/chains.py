"""Decision chains as a stateful stream.

The batch definition is an aggregate per subscriber and action, so the stream is
the same aggregate kept in Spark's state store: a chain's state is the first
event id of each step and a counter, however many events it gets, and events
are combined map-side before they reach it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.history import CHAIN_STEPS, decision_chains
from tidewatch.streaming import batches

LOG = "event_id bigint, subscriber_id string, action_date date, created_at timestamp_ntz, event_type string"
CHAIN = ("subscriber_id string, action_date date, n_events bigint, " + ", ".join(f"{s} bigint" for s in CHAIN_STEPS)
         + ", missing_steps string, verdict string")


def chain_updates(log: DataFrame, keep_days: int | None = None) -> DataFrame:
    """One row per chain that changed in a micro-batch (update mode).

    Without ``keep_days`` the state is never dropped and late events always
    count.  With it, state is released that many days after a chain's day, and
    events later than that are left out by the watermark.
    """
    if keep_days is None:
        return decision_chains(log)
    timed = log.withColumn("created_at", F.col("created_at").cast("timestamp")).withWatermark("created_at", f"{keep_days} days")
    return decision_chains(timed.withColumn("day", F.window("created_at", "1 day")), extra_keys=("day",))


def stream_chains(log: DataFrame, root: str, checkpoint: str, keep_days: int | None = None) -> None:
    batches.run_available(chain_updates(log, keep_days), lambda df, batch_id: batches.put(df, f"{root}/chains", batch_id),
                          checkpoint, mode="update")


def read_chains(spark: SparkSession, root: str) -> DataFrame:
    """The newest row of every chain; its event counter only grows."""
    rows = batches.get(spark, f"{root}/chains", CHAIN)
    keys = ("subscriber_id", "action_date")
    return (rows.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in rows.columns if c not in keys]), F.col("n_events")).alias("s"))
            .select(*keys, "s.*"))
