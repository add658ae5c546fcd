"""Data-quality rules: one row per rule with the number of offending rows."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import rules
from tidewatch.operators import metrics
from tidewatch.params import BANDS, PLANS, REASONS, Params

RED = ("critical", "elevated")


@dataclass(frozen=True)
class Expected:
    """Targets of the dataset at hand; the rules compare per-subscriber values."""
    healthy_share: Decimal = Decimal("0.9")
    clv_per_subscriber: Decimal = Decimal("40")
    tickets_per_subscriber: Decimal = Decimal("0.16")
    tolerance: Decimal = Decimal("0.2")


def _bad(cond: Column) -> Column:
    """1 when a condition that must hold does not (or is unknown)."""
    return F.when(cond, F.lit(0)).otherwise(F.lit(1)).cast("bigint")


def _rows(one: DataFrame) -> DataFrame:
    """A one-row frame of rule columns as (rule, n_bad) rows."""
    pairs = F.array(*[F.struct(F.lit(c).alias("rule"), F.col(c).cast("bigint").alias("n_bad")) for c in one.columns])
    return one.select(F.inline(pairs))


def _within(value: Column, target: Decimal, tol: Decimal) -> Column:
    return value.between(F.lit(float(target * (1 - tol))), F.lit(float(target * (1 + tol))))


def position_rules(position: DataFrame, focus: str | None, e: Expected) -> DataFrame:
    """Rules on the current position, from one pass.

    The focus subscriber is the one given, or the one with the most CLV at risk.
    """
    facts = F.struct("churn_risk_score", "risk_band", "churn_reason", "has_open_outage", "has_open_billing", "clv_at_risk_usd")
    key = F.struct("clv_at_risk_usd", "subscriber_id")
    hero = F.max_by(facts, key if focus is None else F.when(F.col("subscriber_id") == focus, key))
    red, healthy = F.col("risk_band").isin(*RED), F.col("risk_band") == "healthy"
    n = F.count(F.lit(1))
    score = F.col("churn_risk_score")
    signal = F.col("churn_signal_score")
    in_range = lambda c, lo, hi: F.coalesce(F.col(c).between(lo, hi), F.lit(False))
    one = position.agg(
        hero.alias("h"), n.alias("n"), F.count_if(healthy).alias("healthy"),
        F.sum("clv_at_risk_usd").cast("double").alias("clv"), F.sum("open_ticket_count").cast("double").alias("tickets"),
        F.count_if(red & (signal < 0.6)).alias("q06_red_signal_low"), F.count_if(healthy & (signal > 0.2)).alias("q06_healthy_signal_high"),
        F.count_if(F.col("risk_band").isin(*RED, "watch") & (F.col("churn_reason") != "service")).alias("q10_book_not_service"),
        F.count_if(~F.coalesce(F.col("plan_type").isin(*PLANS), F.lit(False))).alias("q11_plan_enum"),
        F.count_if(~F.coalesce(F.col("churn_reason").isin(*REASONS), F.lit(False))).alias("q11_reason_enum"),
        F.count_if(~F.coalesce(F.col("risk_band").isin(*BANDS), F.lit(False))).alias("q11_band_enum"),
        F.count_if(~in_range("churn_risk_score", 0, 1)).alias("q11_score_range"),
        F.count_if(~(in_range("sub_lat", -90, 90) & in_range("sub_lng", -180, 180))).alias("q11_geo"))
    h = F.col("h")
    return _rows(one.select(
        _bad((h["churn_risk_score"] >= 0.75) & (h["risk_band"] == "critical") & (h["churn_reason"] == "service")
             & (h["has_open_outage"] | h["has_open_billing"]) & (h["clv_at_risk_usd"] > 0)).alias("q01_focus_subscriber"),
        _bad(rules.offer_for_reason(h["churn_reason"]) == "bill_credit").alias("q02_focus_offer"),
        _bad(F.col("healthy") >= F.col("n") * float(e.healthy_share)).alias("q04_mostly_healthy"),
        _bad(_within(F.col("clv") / F.col("n"), e.clv_per_subscriber, e.tolerance)).alias("q05_exposure"),
        _bad(_within(F.col("tickets") / F.col("n"), e.tickets_per_subscriber, e.tolerance)).alias("q05_tickets"),
        *[c for c in one.columns if c.startswith("q")]))


def node_rule(position: DataFrame) -> DataFrame:
    """One node holds most of the critical and elevated subscribers."""
    by_node = position.filter(F.col("risk_band").isin(*RED)).groupBy("service_node_id").agg(F.count(F.lit(1)).alias("n"))
    return _rows(by_node.agg(_bad(F.max("n") * 2 > F.sum("n")).alias("q03_node_dominates")))


def note_rule(snapshots: DataFrame) -> DataFrame:
    return _rows(metrics.note_dedup_ratio(snapshots).select(
        _bad(F.col("n_distinct") * 10 <= F.col("n_notes")).alias("q07_notes_repeat")))


def outcome_rule(outcomes: DataFrame) -> DataFrame:
    """The fitting offer has the best mean net value for every reason."""
    best = metrics.best_offer_by_reason(metrics.offer_outcomes(outcomes))
    return _rows(best.agg(F.count_if(F.col("best_by_net") != rules.offer_for_reason(F.col("churn_reason")))
                          .alias("q08_offers_learnable")))


def ramp_rule(snapshots: DataFrame, cohort: DataFrame, p: Params) -> DataFrame:
    """The cohort's mean risk rose from the first to the last week."""
    weekly = metrics.risk_trend(snapshots, cohort, p, "week").filter("in_cohort")
    return _rows(weekly.agg(_bad(F.min_by("avg_churn_risk", "period") < F.max_by("avg_churn_risk", "period"))
                            .alias("q09_ramp_in_past")))


def cube_rule(position: DataFrame, cube: DataFrame) -> DataFrame:
    """Totals from the cube equal totals from the base table."""
    base = metrics.metric(position).select(F.struct("*").alias("b"))
    both = metrics.metric_from_cube(cube).withColumn("b", base.scalar())
    same = reduce(lambda a, b: a & b, [F.col(m).eqNullSafe(F.col(f"b.{m}")) for m in metrics.MEASURES])
    return _rows(both.select(_bad(same).alias("q12_cube_equals_base")))


def key_rule(df: DataFrame, key: str, name: str) -> DataFrame:
    repeated = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    return _rows(repeated.agg(F.count(F.lit(1)).alias(f"q13_key_{name}")))


def reference_rule(child: DataFrame, parent: DataFrame, key: str, name: str) -> DataFrame:
    """Child rows without a parent; children are counted per key before the join."""
    per_key = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    lost = per_key.join(parent.select(key), key, "left_anti")
    return _rows(lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias(f"q13_ref_{name}")))


def recommendation_rules(recs: DataFrame, position: DataFrame) -> DataFrame:
    """Offer mix and totals; holds for the heuristic and for the learned ranking."""
    total = position.agg(F.sum("clv_at_risk_usd").cast("double")).scalar()
    mix = recs.groupBy("recommended_offer").agg(F.count(F.lit(1)).alias("n"), F.sum("predicted_retained_clv_usd").cast("double").alias("kept"))
    one = mix.agg(F.max("n").alias("top"), F.sum("n").alias("n"), F.sum("kept").alias("kept")).withColumn("clv", total)
    return _rows(one.select(_bad(F.col("top") < F.col("n")).alias("q14_offer_mix"),
                            _bad(F.col("kept") <= F.col("clv")).alias("q14_rollup")))


def quality_report(parts: list[DataFrame]) -> DataFrame:
    report = reduce(DataFrame.unionByName, parts)
    return report.withColumn("passed", F.col("n_bad") == 0)


def duplicate_keys(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows, keys that repeat, and the rows they hold, for each table."""
    parts = []
    for name, (df, key) in tables.items():
        per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        parts.append(per_key.agg(F.sum("n").alias("n_rows"), F.count_if(F.col("n") > 1).alias("n_duplicate_keys"),
                                 F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("n_duplicate_rows"))
                     .select(F.lit(name).alias("table_name"), "n_rows", "n_duplicate_keys", "n_duplicate_rows"))
    return reduce(DataFrame.unionByName, parts)


