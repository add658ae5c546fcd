"""Business rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch.params import REASON_OFFER, Params

MONEY = "decimal(12,2)"
SCORE = "decimal(10,6)"
AUDIT_TRAIL = "array<struct<at:string,by:string,action:string,notes:string,tool:string>>"


def dec(value) -> Column:
    """A decimal literal; a float literal would turn money into binary doubles."""
    return F.lit(value)


def money(col: Column) -> Column:
    return col.cast(MONEY)


def exact_avg(total: Column, count: Column) -> Column:
    """Mean from a decimal sum, so the result does not depend on row order."""
    return F.round(F.try_divide(total.cast("double"), count.cast("double")), 6)


def risk_band(score: Column, open_tickets: Column, p: Params) -> Column:
    s = score.cast(SCORE)
    return (F.when((s >= dec(p.critical_score)) & (open_tickets > 0), "critical")
            .when(s >= dec(p.at_risk_score), "elevated")
            .when(s >= dec(p.watch_score), "watch")
            .otherwise("healthy"))


def clv_at_risk(arpu: Column, score: Column, p: Params) -> Column:
    s = score.cast(SCORE)
    return money(F.when(s >= dec(p.at_risk_score), arpu * p.clv_months * s).otherwise(F.lit(0)))


def offer_for_reason(reason: Column) -> Column:
    expr = F.lit(None).cast("string")
    for name, offer in REASON_OFFER.items():
        expr = F.when(reason == name, offer).otherwise(expr)
    return expr


def offer_plays(clv: Column, arpu: Column, reason: Column, p: Params) -> Column:
    """The three plays of one subscriber as an array, best net value first.

    The array lives inside the row, so ranking the plays costs no shuffle.
    Equal net values keep the order bill credit, plan discount, device.
    """
    plays = (
        ("bill_credit", F.when(reason == "service", dec(p.bill_credit_hit)).otherwise(dec(p.bill_credit_miss)),
         dec(p.bill_credit_cost)),
        ("plan_upgrade_discount", F.when(reason == "price", dec(p.plan_discount_hit)).otherwise(dec(p.plan_discount_miss)),
         arpu * dec(p.plan_discount_rate) * p.plan_discount_months),
        ("device_upgrade", F.when(reason == "device", dec(p.device_hit)).otherwise(dec(p.device_miss)),
         dec(p.device_cost)),
    )
    options = []
    for i, (name, prob, cost) in enumerate(plays):
        retained, price = money(clv * prob), money(cost)
        net = money(retained - price)
        options.append(F.struct(
            (-net).alias("sort_net"), F.lit(i).alias("sort_order"),
            F.lit(name).alias("offerType"), price.alias("costUsd"),
            retained.alias("predictedRetainedClvUsd"), net.alias("predictedNetValueUsd")))
    return F.sort_array(F.array(*options))


def ranking_json(plays: Column) -> Column:
    return F.to_json(F.transform(plays, lambda o: F.struct(
        o["offerType"].alias("offerType"), o["costUsd"].alias("costUsd"),
        o["predictedRetainedClvUsd"].alias("predictedRetainedClvUsd"),
        o["predictedNetValueUsd"].alias("predictedNetValueUsd"))))


def priority_score(outcome: Column) -> Column:
    # Triage weight of each action outcome.
    return (F.when(outcome == "escalated", 95).when(outcome == "pending", 80)
            .when(outcome == "retained", 10).when(outcome == "approved", 0)
            .cast("decimal(5,2)"))


def value_unit(offer_type: Column) -> Column:
    """Plan discounts are stored as a fraction of the bill, the rest in dollars."""
    return F.when(offer_type == "plan_upgrade_discount", "fraction").otherwise("usd")


def rate_severity(pct: Column) -> Column:
    return F.when(pct >= 20, "danger").when(pct >= 10, "warning").otherwise("normal")


def anger_severity(score: Column) -> Column:
    return F.when(score >= 0.7, "high").when(score >= 0.4, "medium").when(score.isNotNull(), "low")


def is_hidden_premium(tier: Column, label: Column) -> Column:
    """Predicted premium that nobody tagged premium by hand."""
    return F.coalesce(tier == "premium", F.lit(False)) & ~F.coalesce(label == "premium", F.lit(False))


def is_labeled_premium(tier: Column, label: Column) -> Column:
    return F.coalesce((tier == "premium") & (label == "premium"), F.lit(False))


def audit_entry(at: Column, by: Column, action: Column, notes: Column, tool: Column) -> Column:
    return F.struct(at.alias("at"), by.alias("by"), action.alias("action"),
                    notes.alias("notes"), tool.alias("tool"))
