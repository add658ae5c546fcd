"""Change history: SCD type 2, latest state, decision chains."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.windows import neighbour
from tidewatch.params import Params

# The steps of a decision, in order.
CHAIN_STEPS = ("risk_trigger", "offer_recommended", "action_submitted", "action_approved")


def followed(feed: DataFrame, p: Params) -> DataFrame:
    """Every change once, with the time and position of the next change of its key.

    A redelivered change sits right before its copy, so it is the row whose next
    position equals its own; dropping it needs no shuffle beyond the window's.
    """
    led = neighbour(feed, ["entity_key"], "lsn", {"valid_to": "changed_at", "next_lsn": "lsn"}, p.hot_key_rows, forward=True)
    return led.filter(F.col("next_lsn").isNull() | (F.col("next_lsn") != F.col("lsn")))


def scd2(feed: DataFrame, p: Params) -> DataFrame:
    """Versions of every key with validity intervals, ordered by log position.

    A redelivered change (same key and position) counts once; a delete closes
    the version before it and opens none.
    """
    return (followed(feed, p).filter(F.col("change_type") != "delete")
            .select("entity_key", "lsn", "state", F.col("changed_at").alias("valid_from"), "valid_to",
                    F.col("next_lsn").isNull().alias("is_current")))


def latest_state(feed: DataFrame) -> DataFrame:
    """Newest change per key, combined map-side; deleted keys are gone."""
    return (feed.groupBy("entity_key").agg(
        F.max_by(F.struct("lsn", "state", "changed_at", "change_type"), F.col("lsn")).alias("s"))
        .select("entity_key", "s.*").filter(F.col("change_type") != "delete").drop("change_type"))


def chain_columns() -> list:
    """Step flags, order check and verdict from the first event id of every step."""
    first = [F.col(s) for s in CHAIN_STEPS]
    complete = reduce(lambda a, b: a & b, [c.isNotNull() for c in first])
    in_order = reduce(lambda a, b: a & b, [a < b for a, b in zip(first, first[1:])])
    missing = F.array_join(F.array_compact(F.array(*[F.when(c.isNull(), s) for c, s in zip(first, CHAIN_STEPS)])), ",")
    verdict = F.when(complete & in_order, "complete").when(complete, "out_of_order").otherwise("incomplete")
    return [missing.alias("missing_steps"), verdict.alias("verdict")]


def decision_chains(log: DataFrame, extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """One verdict per subscriber and action, for a table or a stream.

    The order of steps is decided by the first event of each kind, which is a
    plain aggregate; no chain is ever sorted or collected.
    """
    first = log.groupBy("subscriber_id", "action_date", *extra_keys).agg(
        F.count(F.lit(1)).alias("n_events"),
        *[F.min(F.when(F.col("event_type") == s, F.col("event_id"))).alias(s) for s in CHAIN_STEPS])
    return first.select("subscriber_id", "action_date", "n_events", *CHAIN_STEPS, *chain_columns())
