"""Every tunable of the pipeline, as explicit arguments.

Nothing in the package asks for the current date: a run is a function of its
tables and of one ``Params``.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta
from decimal import Decimal

# Enumerations of the data model.
PLANS = ("broadband", "mobile", "bundle")
REASONS = ("service", "price", "device")
OFFER_TYPES = ("bill_credit", "plan_upgrade_discount", "device_upgrade")
BANDS = ("critical", "elevated", "watch", "healthy")
TICKET_TYPES = ("outage", "billing", "technical", "general")
CHANNELS = ("phone", "chat", "app")
EVENT_TYPES = ("outage", "degradation")
RETURN_STATUSES = ("pending", "approved", "rejected", "escalated")
ACTION_TYPES = ("offer_presented", "follow_up", "escalation")
ACTION_OUTCOMES = ("pending", "approved", "escalated", "retained", "declined", "overridden")

# The play that answers each churn reason.
REASON_OFFER = {
    "service": "bill_credit",
    "price": "plan_upgrade_discount",
    "device": "device_upgrade",
}


@dataclass(frozen=True)
class Params:
    as_of: date = date(2024, 1, 30)

    # Lifetime value and risk bands.
    clv_months: int = 24
    at_risk_score: Decimal = Decimal("0.6")
    critical_score: Decimal = Decimal("0.75")
    watch_score: Decimal = Decimal("0.4")

    # Retain probability when the offer fits the reason / when not, and cost.
    bill_credit_hit: Decimal = Decimal("0.7")
    bill_credit_miss: Decimal = Decimal("0.3")
    bill_credit_cost: Decimal = Decimal("40")
    plan_discount_hit: Decimal = Decimal("0.65")
    plan_discount_miss: Decimal = Decimal("0.3")
    plan_discount_rate: Decimal = Decimal("0.2")
    plan_discount_months: int = 12
    device_hit: Decimal = Decimal("0.6")
    device_miss: Decimal = Decimal("0.25")
    device_cost: Decimal = Decimal("300")

    # Note classes.
    score_churn_signal: float = 1.0
    score_at_risk: float = 0.6
    score_healthy: float = 0.1

    # Windows the specification leaves open.
    event_lookback_days: int = 30
    trend_weeks: int = 8
    refund_trend_days: int = 30
    sparkline_days: int = 30

    # Days a decision chain stays in a stream's state; events later than that do not count.
    chain_keep_days: int = 3660

    # A key with more rows than this is split into segments of this many sequence numbers.
    hot_key_rows: int = 1_000_000

    @property
    def recent_bill_month(self) -> date:
        """First day of the month before ``as_of``."""
        return (self.as_of.replace(day=1) - timedelta(days=1)).replace(day=1)
