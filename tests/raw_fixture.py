"""A small set of the eight raw datasets with a story: subscribers of one node lost service, complained and may leave."""

from datetime import date, timedelta
from decimal import Decimal

from tidewatch.params import PLANS
from tidewatch.sources import raw

AS_OF = date(2026, 7, 31)
PEOPLE, UNHAPPY = 900, 60  # the first UNHAPPY subscribers are on the node that failed
FOCUS, NODE = "SUB-0000007", "NODE-FAIL"
REASONS = ("service", "price", "device")
FIT = {"service": "bill_credit", "price": "plan_upgrade_discount", "device": "device_upgrade"}


def key(i: int) -> str:
    return f"SUB-{i:07d}"


def rows() -> dict[str, list[tuple]]:
    day = timedelta(days=1)
    subscribers = [(key(i), f"Customer {i}", PLANS[i % len(PLANS)], 6 + i % 60, Decimal(40 + i % 50), NODE if i < UNHAPPY else f"NODE-{i % 9}", f"Metro {i % 5}", "TX",
                    30.0 + i % 10, -95.0 - i % 10, AS_OF - (100 + i) * day, f"summary of customer {i}", True) for i in range(PEOPLE)]
    offers = [("OFFER-001", "Credit", "bill_credit", 50.0, "all", "credit after an outage", True),
              ("OFFER-002", "Large credit", "bill_credit", 90.0, "high_value", "larger credit", True),
              ("OFFER-003", "Discount", "plan_upgrade_discount", 0.2, "all", "discount for price reasons", True),
              ("OFFER-005", "Device", "device_upgrade", 300.0, "high_value", "new device", True)]
    usage = [(key(i), AS_OF - d * day, Decimal(1 + (i + d) % 7), (i * d) % 50, Decimal(d)) for i in range(PEOPLE) for d in range(5)]
    billing = [(f"BILL-{i}-{m}", key(i), date(2026, m, 1), Decimal(60), i < UNHAPPY and m == 7, "outage charge" if i < UNHAPPY and m == 7 else None)
               for i in range(PEOPLE) for m in (5, 6, 7)]
    tickets = [(f"T-{i}", key(i), "outage" if i % 2 else "billing", AS_OF - 4 * day, None if i < UNHAPPY else AS_OF - day, "phone",
                "called about outage, not resolved" if i < UNHAPPY else "routine support call, resolved") for i in range(0, 300)]
    events = [(f"NET-{n}-{d}", f"NODE-{n}", "maintenance", AS_OF - d * day, 30, 10) for n in range(9) for d in range(0, 60, 7)]
    events.append(("NET-FAIL", NODE, "outage", AS_OF - 6 * day, 400, UNHAPPY))
    snapshots = [(key(i), AS_OF - d * day, round(0.8 - 0.04 * d, 2), "service", 1, "threatening to leave after outage") for i in range(UNHAPPY) for d in range(14)]
    snapshots += [(key(i), AS_OF - (i % 3) * day, 0.05 + (i % 20) / 100, REASONS[i % 3], 0, "satisfied, no issues") for i in range(UNHAPPY, PEOPLE)]
    history = []
    for n in range(900):
        offer, reason = list(FIT.values())[n % 3], REASONS[n // 3 % 3]
        kept = FIT[reason] == offer if n % 10 else n % 20 == 0
        cost = {"bill_credit": 40, "plan_upgrade_discount": 130, "device_upgrade": 300}[offer]
        history.append((f"R-{n}", key(n % PEOPLE), offer, reason, Decimal(60 + n % 7), AS_OF - (n % 300) * day, Decimal(cost), kept, Decimal(900 if kept else 100)))
    return {"subscribers": subscribers, "offers": offers, "usage": usage, "billing": billing, "tickets": tickets, "network_events": events,
            "risk_snapshots": snapshots, "retention_offers": history}


def frames(spark) -> dict:
    return {name: spark.createDataFrame(data, raw.RAW_SCHEMAS[name]) for name, data in rows().items()}
