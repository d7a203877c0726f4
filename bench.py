"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Each query: one warm-up run, then the median of 3 timed runs; a run is the
full plan executed to completion with a no-op sink (``write.format("noop")``),
so nothing is collected to the driver.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

from ledgerflow.plans.catalog import REGISTRY
from ledgerflow.session import build_session

HEADLINE = [
    "a1_merchant_performance", "a2_daily_summary", "a3_customer_ltv", "b2_fct_transactions",
    "b4_fct_daily_revenue", "a4_mart_merchant_kpis", "q13_suite_transactions", "q14_quarantine_split",
    "q1_profile_bronze", "g1_pii_scan_documents", "r16_keyword_search", "r17_vector_top3",
    "w4_rolling_4h_value", "r6_zero_load_alarm", "t4_top5_values_per_column", "b13_reconciliation_summary",
]


def run_once(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> int:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    only = sys.argv[1:]
    spark = build_session()
    names = [n for n in (only or HEADLINE) if n in REGISTRY]
    times: dict[str, float] = {}
    for name in names:
        q = REGISTRY[name]
        run_once(q.build(spark, sf_dir))  # warm-up
        samples = []
        for _ in range(reps):
            t0 = time.perf_counter()
            run_once(q.build(spark, sf_dir))
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "median_sec_per_query_sum",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else None,
        "cpus": int(os.environ.get("BENCH_CPUS", "8")),
        "n_queries": len(times),
    }
    print(json.dumps(out))
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
