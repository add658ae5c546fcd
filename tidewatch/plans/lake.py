"""Lazily planned tables over one data directory."""

from __future__ import annotations

from datetime import timedelta
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators import gold, metrics, silver
from tidewatch.params import Params
from tidewatch.session import cut_lineage
from tidewatch.sources import adapters, raw


class Lake:
    """Raw tables, adapter views, silver and gold as DataFrames.

    Every property only builds a logical plan; nothing runs until an action, and
    Catalyst sees one plan per query.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, params: Params | None = None):
        self.spark, self.sf_dir, self.p = spark, sf_dir, params or Params()
        self._views: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        """A base table or adapter view."""
        if name not in self._views:
            if name in adapters.BASE_TABLES:
                self._views[name] = adapters.read_table(self.spark, f"{self.sf_dir}/{name}.parquet")
            else:
                self._views[name] = adapters.bind_view(self.spark, name, self.__getitem__)
        return self._views[name]

    def narrowed(self, **tables: DataFrame) -> "Lake":
        """The same views over other frames for some of the tables, to have a filter reach the scans."""
        lake = type(self)(self.spark, self.sf_dir, self.p)
        lake._views.update(tables)
        return lake

    def recent_snapshots(self, days: int) -> DataFrame:
        """At least the snapshots of the last days.

        A snapshot looks back six days, so events before that cannot count; whether a subscriber ever had one is still read from all.
        """
        events = self["events"]
        since = F.lit(self.p.as_of - timedelta(days=days + 5)).cast(events.schema["ts"].dataType)
        return self.narrowed(events=events.filter(F.col("ts") >= since), event_users=self["event_users"])["risk_snapshots"]

    def of_subscriber(self, subscriber_id: str) -> "Lake":
        """The tables of one subscriber: the id is translated to the key that the scans can be filtered by."""
        index = int(subscriber_id.removeprefix("SUB-")) - 1
        return self.narrowed(customer=self["customer"].filter(F.col("c_custkey") == index), events=self["events"].filter(F.col("user_id") == index),
                             orders=self["orders"].filter(F.col("o_custkey") == index))

    def of_return(self, return_id: str) -> "Lake":
        """The tables of one return, by the order it belongs to."""
        order = int(return_id.split("-")[0])
        return self.narrowed(lineitem=self["lineitem"].filter(F.col("l_orderkey") == order), orders=self["orders"].filter(F.col("o_orderkey") == order))

    @cached_property
    def flags(self) -> DataFrame:
        return silver.note_churn_flags(self["risk_snapshots"], self.p)

    @cached_property
    def tickets_rollup(self) -> DataFrame:
        return silver.silver_tickets(self["tickets"])

    @cached_property
    def billing_rollup(self) -> DataFrame:
        return silver.silver_billing(self["billing"], self.p)

    @cached_property
    def silver_risk(self) -> DataFrame:
        return silver.silver_risk(self["risk_snapshots"], self["subscribers"], self.p)

    @cached_property
    def outcomes(self) -> DataFrame:
        return gold.retention_outcomes(silver.silver_retention(self["retention_history"], self["subscribers"]))

    def position_at(self, p: Params) -> DataFrame:
        return gold.subscriber_position(
            gold.current_snapshot(self["risk_snapshots"], p), self["subscribers"],
            self.tickets_rollup, silver.silver_billing(self["billing"], p), p)

    @cached_property
    def position(self) -> DataFrame:
        return self.position_at(self.p)

    @cached_property
    def book(self) -> DataFrame:
        """At-risk rows (critical, elevated, watch) without the linked event."""
        return gold.at_risk_book(self.position)

    @cached_property
    def recs(self) -> DataFrame:
        return gold.recommendations(self.book, self.p)

    @cached_property
    def scored(self) -> DataFrame:
        """Position with the ranked offer of its at-risk rows."""
        return gold.with_ranked_offer(self.position, self.p)

    def pin(self, name: str) -> "Lake":
        """Compute a table once for a query that reads it several times."""
        self.__dict__[name] = cut_lineage(getattr(self, name))
        return self

    @cached_property
    def open_atrisk(self) -> DataFrame:
        return gold.open_atrisk(self.book, self["network_events"], self["offers"], self.p)

    @cached_property
    def cube(self) -> DataFrame:
        return metrics.metric_cube(self.position)

    @cached_property
    def cohort(self) -> DataFrame:
        """The current critical and elevated subscribers."""
        return self.position.filter(F.col("risk_band").isin("critical", "elevated")).select("subscriber_id")


class RawLake(Lake):
    """The same silver and gold tables over the eight raw datasets under a root."""

    def __getitem__(self, name: str) -> DataFrame:
        dataset = "retention_offers" if name == "retention_history" else name
        return raw.read_raw(self.spark, self.sf_dir, dataset)

    def recent_snapshots(self, days: int) -> DataFrame:
        """All snapshots: they are stored, so a consumer's filter on the date reaches the scan."""
        return self["risk_snapshots"]
