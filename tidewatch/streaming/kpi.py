"""Action stream to live counters, as additive partials per micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.actions import APPLIED, RED
from tidewatch.streaming import batches

ACTIONS = "action_id bigint, subscriber_id string, outcome string, created_at timestamp_ntz"
DAILY = "day date, n_actions bigint, n_applied bigint"
SAVED = "subscriber_id string, day date"


class KpiWriter:
    """Counts per day, and the first day each subscriber was saved, of one batch."""

    def __init__(self, root: str):
        self.root = root

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        day = F.col("created_at").cast("date")
        applied = F.col("outcome").isin(*APPLIED)
        batches.put(batch.filter(applied).groupBy("subscriber_id").agg(F.min(day).alias("day")),
                    f"{self.root}/saved", batch_id)
        batches.put(batch.groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("n_actions"), F.count_if(applied).alias("n_applied")),
                    f"{self.root}/daily", batch_id)


def stream_kpi(actions: DataFrame, root: str, checkpoint: str) -> None:
    batches.run_available(actions, KpiWriter(root), checkpoint)


def read_kpi(spark: SparkSession, root: str, position: DataFrame) -> DataFrame:
    done = batches.finished(spark, f"{root}/daily")
    daily = batches.total(batches.get(spark, f"{root}/daily", DAILY, done), ["day"], ["n_actions", "n_applied"])
    first = batches.get(spark, f"{root}/saved", SAVED, done).groupBy("subscriber_id").agg(F.min("day").alias("day"))
    red = position.filter(F.col("risk_band").isin(*RED)).select("subscriber_id", "clv_at_risk_usd")
    saved = first.join(red, "subscriber_id").groupBy("day").agg(
        F.count(F.lit(1)).alias("newly_saved"), F.sum("clv_at_risk_usd").alias("clv_drop_usd"))
    return daily.join(saved, "day", "left").fillna(0, ["newly_saved"]).withColumn(
        "clv_drop_usd", F.coalesce("clv_drop_usd", F.lit(0)))
