"""Raw datasets: one parquet directory per dataset, declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW_SCHEMAS: dict[str, str] = {
    "subscribers": "subscriber_id string, sub_display_name string, plan_type string, tenure_months int, monthly_arpu_usd decimal(9,2), service_node_id string, home_metro string, state string, sub_lat double, sub_lng double, activation_date date, service_summary string, is_active boolean",
    "offers": "offer_id string, offer_name string, offer_type string, value_usd double, segment string, description string, is_active boolean",
    "usage": "subscriber_id string, usage_date date, data_gb decimal(9,2), voice_min int, stream_hours decimal(9,2)",
    "billing": "bill_id string, subscriber_id string, bill_month date, amount_usd decimal(9,2), disputed boolean, dispute_reason string",
    "tickets": "ticket_id string, subscriber_id string, ticket_type string, opened_date date, closed_date date, channel string, note_text string",
    "network_events": "event_id string, node_id string, event_type string, event_date date, duration_min int, subscribers_affected int",
    "risk_snapshots": "subscriber_id string, snapshot_date date, churn_risk_score double, churn_reason string, open_ticket_count int, agent_note_text string",
    "retention_offers": "retention_id string, subscriber_id string, offer_type string, churn_reason string, monthly_arpu_usd decimal(9,2), initiated_date date, offer_cost_usd decimal(9,2), retained boolean, retained_clv_usd decimal(12,2)",
}


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_raw(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One dataset with its declared schema; no footer is read to infer it."""
    return spark.read.schema(RAW_SCHEMAS[name]).parquet(f"{root}/{name}")


def read_all(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {name: read_raw(spark, root, name) for name in RAW_SCHEMAS}


def read_optional(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """A table that may not exist yet reads as an empty frame of its declared schema."""
    if _exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def write_raw(df: DataFrame, root: str, name: str) -> int:
    """Overwrite one dataset and return its row count, counted while it is written."""
    seen = Observation(f"rows_{name}")
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{root}/{name}")
    return seen.get["n"]
