"""Seconds per headline query, printed as one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Every query is run to the end through the ``noop`` sink (all rows and columns
are produced, nothing is collected).  One untimed run warms the JVM; the best of
``BENCH_RUNS`` timed runs counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidewatch.plans import catalog  # noqa: E402
from tidewatch.session import local_session  # noqa: E402

HEADLINE = (
    "atrisk_view", "subscriber_position", "retention_recommendations", "open_atrisk", "metric_cube", "metric_from_cube",
    "worst_lots", "lot_premium_breakdown", "city_breakdown", "customer_orders", "usage_daily", "bm25_topk", "note_search",
    "history_search", "scd2_history", "decision_chain", "risk_trend_weekly", "offer_outcomes", "render_messages", "vector_topk",
)


def timed(fn, runs: int) -> float:
    fn()
    best = float("inf")
    for _ in range(runs):
        start = time.perf_counter()
        fn()
        best = min(best, time.perf_counter() - start)
    return round(best, 3)


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(cpus)
    queries = {name: timed(lambda n=name: drain(catalog.runner(n)(spark, sf_dir)), runs) for name in HEADLINE}
    print(json.dumps({
        "metric": "headline queries, total seconds", "value": round(sum(queries.values()), 3), "unit": "sec",
        "queries": queries, "sf": os.path.basename(sf_dir.rstrip("/")),
        "config": {"cpus": cpus, "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
                   "driver_memory": spark.sparkContext.getConf().get("spark.driver.memory"), "spark": spark.version}}))


if __name__ == "__main__":
    main()
