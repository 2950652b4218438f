"""Benchmark the headline queries.

Runs each query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and executes it fully through the ``noop`` sink (every
row produced, nothing collected). Four passes: the first (cold JVM) is
reported as ``cold_*``, the median of the other three is the headline. Prints one
JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from changelake.session import build_session  # noqa: E402
from changelake.plans import registry  # noqa: E402

HEADLINE = [
    "cdc_reconcile",
    "cdc_reconcile_composite",
    "events_current_state",
    "validate_dim_customer",
    "validate_dim_product",
    "validate_fact_orders",
    "validate_fact_order_items",
    "quarantine_fact_order_items",
    "validate_fact_payments",
    "validate_fact_shipments",
    "orphan_items",
    "row_counts",
    "quarantine_summary",
    "layer_divergence",
    "gold_vs_silver_counts",
    "mart_items_one_month",
    "dq_one_per_parent",
    "mart_revenue_by_month",
    "mart_delivery_days",
    "mart_product_performance",
    "roundtrip_fact",
    "stream_current_state",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else None
    # spark.checkpoint.dir comes from the cluster defaults when set; the
    # session helper fills a private folder only when it is unset (local).
    spark = build_session(f"local[{cpus}]", app_name="changelake-bench",
                          shuffle_partitions=int(cpus) * 2,
                          extra_conf={"spark.driver.memory": "16g"})
    only = sys.argv[1:] or HEADLINE

    def timed_pass() -> dict[str, float]:
        out = {}
        for name in only:
            t0 = time.perf_counter()
            registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            out[name] = round(time.perf_counter() - t0, 3)
        return out

    # Pass 1 is cold (class loading, code generation, JIT). The median of the
    # passes after it is the steady state of a long-running job: the headline.
    cold = timed_pass()
    passes = [timed_pass() for _ in range(3)]
    warm = {name: statistics.median(p[name] for p in passes) for name in only}
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(warm.values()), 3),
                      "unit": "sec", "queries": warm, "sf": sf,
                      "cold_total_sec": round(sum(cold.values()), 3), "cold_queries": cold}))
    spark.stop()


if __name__ == "__main__":
    main()
