"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf"}.
Each query is timed end to end (plan + execution) with a full consume of the
result (``count`` on a no-op write would let Spark prune columns, so rows
are written to the ``noop`` sink instead).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from orderlake.plans.registry import queries  # noqa: E402
from orderlake.session import build_session  # noqa: E402

HEADLINE = [
    "silver_orders_header", "silver_orders_items", "product_monthly", "customer_rfm", "product_anomaly",
    "gold_orders", "nest_orders", "read_all_orders", "ledger_order_writes", "latest_order_state",
    "block_transactions", "tx_rwset", "verify_customers", "publish_orders", "order_lifecycle",
    "rejected_events", "order_features", "standardized_features", "order_pca", "dbscan_orders",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = build_session(f"local[{cpus}]", int(cpus) * 2, app_name="orderlake-bench")
    qs = queries()
    names = only or HEADLINE
    # warm-up: JIT and parquet footers
    try:
        qs["silver_orders_header"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    except Exception:  # noqa: BLE001
        pass
    times, failed = {}, {}
    for name in names:
        t0 = time.time()
        try:
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.time() - t0, 3)
            print(f"# {name}: {times[name]}s", file=sys.stderr)
        except Exception as e:  # noqa: BLE001 - report and keep timing the rest
            failed[name] = str(e)[:200]
            print(f"# {name}: FAILED {failed[name]}", file=sys.stderr)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else sf_dir}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
