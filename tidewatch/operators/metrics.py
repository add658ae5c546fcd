"""Named measures over the subscriber position, at any subset of its dimensions.

Each measure is defined by additive partials plus a finishing expression, so
the same definition serves the base table and the pre-aggregated cube.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import rules

DIMENSIONS = ("plan_type", "churn_reason", "risk_band", "home_metro", "service_node_id", "subscriber_id")
CUBE_DIMENSIONS = ("plan_type", "churn_reason", "risk_band", "home_metro")


def _flag(cond: Column) -> Column:
    return F.when(cond, F.lit(1).cast("bigint")).otherwise(F.lit(0).cast("bigint"))


@dataclass(frozen=True)
class Measure:
    partials: dict  # partial name -> row expression to sum
    finish: object  # function of summed partial columns


def _sum_of(name: str, row) -> Measure:
    return Measure({name: row}, lambda c: c(name))


def _band(*bands: str):
    return lambda: _flag(F.col("risk_band").isin(*bands))


MEASURES: dict[str, Measure] = {
    "clv_at_risk": _sum_of("clv_at_risk", lambda: F.col("clv_at_risk_usd")),
    "open_tickets": _sum_of("open_tickets", lambda: F.col("open_ticket_count").cast("bigint")),
    "subscriber_count": _sum_of("subscriber_count", lambda: F.lit(1).cast("bigint")),
    "critical_count": _sum_of("critical_count", _band("critical")),
    "elevated_count": _sum_of("elevated_count", _band("elevated")),
    "atrisk_count": _sum_of("atrisk_count", _band("critical", "elevated")),
    # NULL inputs do not count, so each mean carries its own number of inputs.
    "avg_churn_risk": Measure(
        {"risk_sum": lambda: F.col("churn_risk_score").cast(rules.SCORE),
         "risk_n": lambda: _flag(F.col("churn_risk_score").isNotNull())},
        lambda c: rules.exact_avg(c("risk_sum"), c("risk_n"))),
    "avg_churn_signal": Measure(
        {"signal_sum": lambda: F.col("churn_signal_score").cast(rules.SCORE),
         "signal_n": lambda: _flag(F.col("churn_signal_score").isNotNull())},
        lambda c: rules.exact_avg(c("signal_sum"), c("signal_n"))),
}


def _check(dims, measures):
    unknown = [d for d in dims if d not in DIMENSIONS] + [m for m in measures if m not in MEASURES]
    if unknown:
        raise ValueError(f"unknown dimension or measure: {unknown}")


def _partials(measures) -> dict:
    return {n: e for m in measures for n, e in MEASURES[m].partials.items()}


def _finish(df: DataFrame, dims, measures) -> DataFrame:
    return df.select(*dims, *[MEASURES[m].finish(F.col).alias(m) for m in measures])


def metric(position: DataFrame, dims=(), measures=tuple(MEASURES)) -> DataFrame:
    """Evaluate measures on the base table."""
    _check(dims, measures)
    sums = [F.sum(e()).alias(n) for n, e in _partials(measures).items()]
    return _finish(position.groupBy(*dims).agg(*sums), dims, measures)


def metric_cube(position: DataFrame) -> DataFrame:
    """Additive partials of every measure at the cube dimensions."""
    sums = [F.sum(e()).alias(n) for n, e in _partials(MEASURES).items()]
    return position.groupBy(*CUBE_DIMENSIONS).agg(*sums)


def metric_from_cube(cube: DataFrame, dims=(), measures=tuple(MEASURES)) -> DataFrame:
    """Evaluate measures from the cube partials."""
    _check(dims, measures)
    sums = [F.sum(n).alias(n) for n in _partials(measures)]
    return _finish(cube.groupBy(*dims).agg(*sums), dims, measures)


def answer(position: DataFrame, cube: DataFrame | None, dims=(), measures=tuple(MEASURES)) -> DataFrame:
    """Use the cube when it covers the dimensions, the base table otherwise."""
    if cube is not None and set(dims) <= set(CUBE_DIMENSIONS):
        return metric_from_cube(cube, dims, measures)
    return metric(position, dims, measures)


def exposure_dataset(position: DataFrame) -> DataFrame:
    return metric(position, CUBE_DIMENSIONS, (
        "clv_at_risk", "open_tickets", "critical_count", "atrisk_count", "subscriber_count"))


def kpi_counters(exposure: DataFrame) -> DataFrame:
    """Dashboard counters: sums of the exposure sums."""
    return exposure.agg(*[F.sum(c).alias(c) for c in
                          ("clv_at_risk", "open_tickets", "critical_count", "atrisk_count")])


def count_by(df: DataFrame, *dims: str) -> DataFrame:
    return df.groupBy(*dims).agg(F.count(F.lit(1)).alias("subscribers"),
                                 F.sum("clv_at_risk_usd").alias("clv_at_risk_usd"))


def risk_mix(position: DataFrame) -> DataFrame:
    return position.groupBy("churn_reason", "risk_band").agg(
        F.count(F.lit(1)).alias("subscribers"),
        F.sum(_flag(F.col("risk_band").isin("critical", "elevated"))).alias("atrisk_subscribers"))


def risk_mix_pivot(position: DataFrame, bands) -> DataFrame:
    """One column per band; the fixed list spares the pivot a pass over the data."""
    wide = position.groupBy("churn_reason").pivot("risk_band", list(bands)).count()
    return wide.fillna(0, list(bands))


def offer_mix(recs: DataFrame) -> DataFrame:
    return recs.groupBy("recommended_offer").agg(
        F.count(F.lit(1)).alias("subscribers"),
        F.sum("predicted_retained_clv_usd").alias("predicted_retained_clv_usd"))


def portfolio_retained(recs: DataFrame) -> DataFrame:
    return recs.agg(F.count(F.lit(1)).alias("subscribers"),
                    F.sum("predicted_retained_clv_usd").alias("predicted_retained_clv_usd"),
                    F.sum("predicted_net_value_usd").alias("predicted_net_value_usd"))


def risk_trend(risk: DataFrame, cohort: DataFrame, p, grain: str) -> DataFrame:
    """Mean risk of the cohort against the rest over the last weeks.

    The snapshots are reduced to one row per subscriber and period before the
    cohort flag is joined.
    """
    period = F.col("snapshot_date") if grain == "day" else F.date_trunc("week", "snapshot_date").cast("date")
    recent = risk.filter((F.col("snapshot_date") > F.date_sub(F.lit(p.as_of), 7 * p.trend_weeks))
                         & (F.col("snapshot_date") <= F.lit(p.as_of)))
    per_sub = recent.groupBy("subscriber_id", period.alias("period")).agg(
        F.sum(F.col("churn_risk_score").cast(rules.SCORE)).alias("s"), F.count("churn_risk_score").alias("n"))
    flagged = per_sub.join(cohort.select("subscriber_id", F.lit(True).alias("c")), "subscriber_id", "left")
    return (flagged.groupBy("period", F.coalesce("c", F.lit(False)).alias("in_cohort"))
            .agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
            .select("period", "in_cohort", F.col("n").alias("snapshots"),
                    rules.exact_avg(F.col("s"), F.col("n")).alias("avg_churn_risk")))


def offer_outcomes(outcomes: DataFrame) -> DataFrame:
    """How well each offer type answered each reason."""
    n = F.count(F.lit(1))
    kept, cost = F.sum("retained_clv_usd"), F.sum("offer_cost_usd")
    return outcomes.groupBy("offer_type", "churn_reason").agg(
        n.alias("n_offers"), F.sum(_flag(F.col("retained"))).alias("n_retained"),
        rules.exact_avg(F.sum(_flag(F.col("retained"))), n).alias("retain_rate"),
        rules.exact_avg(kept, n).alias("avg_retained_usd"), rules.exact_avg(cost, n).alias("avg_cost_usd"),
        rules.exact_avg(kept - cost, n).alias("avg_net_usd"),
        rules.exact_avg(kept, cost).alias("retained_per_cost"))


def best_offer_by_reason(by_offer: DataFrame) -> DataFrame:
    """The offer with the best mean net value, and the one with the best ratio."""
    return by_offer.groupBy("churn_reason").agg(
        F.max_by("offer_type", F.struct("avg_net_usd", "offer_type")).alias("best_by_net"),
        F.max_by("offer_type", F.struct("retained_per_cost", "offer_type")).alias("best_by_ratio"),
        F.max("avg_net_usd").alias("best_avg_net_usd"))


def subscriber_summary(position: DataFrame) -> DataFrame:
    red = position.filter(F.col("risk_band").isin("critical", "elevated"))
    return red.agg(
        F.count(F.lit(1)).alias("total_at_risk"),
        F.coalesce(F.sum(_flag(F.col("risk_band") == "critical")), F.lit(0)).alias("total_critical"),
        F.coalesce(F.sum(_flag(F.col("risk_band") == "elevated")), F.lit(0)).alias("total_elevated"),
        F.coalesce(F.sum("clv_at_risk_usd"), F.lit(0)).alias("total_clv_at_risk_usd"),
        rules.exact_avg(F.sum(F.col("churn_risk_score").cast(rules.SCORE)), F.count(F.lit(1))).alias("avg_churn_risk_score"))


def note_dedup_ratio(risk: DataFrame) -> DataFrame:
    return risk.agg(F.count("agent_note_text").alias("n_notes"),
                    F.countDistinct("agent_note_text").alias("n_distinct"))
