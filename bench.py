"""Time the headline queries and print one JSON line.

BENCH_SF_DIR   directory of the test tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  comma-separated names, default the list below
BENCH_DIR      folder for intermediate tables (default a temporary one)
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from registry.queries import QUERIES  # noqa: E402
from tradewinds import build_session  # noqa: E402

HEADLINE = [
    "daily_metrics",
    "orders_enriched",
    "product_analytics",
    "customer_segments",
    "customer_features",
    "product_features",
    "monthly_metrics",
    "revenue_by_month",
    "top_categories",
    "top_products_daily",
    "integrity_report",
    "duplicate_report",
    "profile_items",
    "load_csv",
    "realtime_orders",
    "realtime_metrics",
    "rolling_metrics",
    "stream_realtime_metrics",
]
RUNS = 2


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
        spark__checkpoint__dir=os.environ.get("BENCH_DIR") or tempfile.mkdtemp(prefix="bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        best = float("inf")
        for _ in range(RUNS):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        seconds[name] = round(best, 3)
    spark.stop()
    print(json.dumps({
        "metric": f"sum of {len(seconds)} queries, best of {RUNS} runs each",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
