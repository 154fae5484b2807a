"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR   tables to read             (default /root/testdata/sf0.1)
BENCH_CPUS     local[N]                   (default: all cores)
BENCH_REPEATS  warm runs, median is taken (default 3)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from orderflume.plans.queries import QUERIES  # noqa: E402
from orderflume.session import build_session  # noqa: E402

HEADLINE = (
    "contract_orders",
    "contract_items",
    "contract_metrics",
    "validation_report",
    "resolve_mapping",
    "attach_surrogates",
    "assembled_events",
    "seller_weekly_fact",
    "customer_weekly_fact",
    "product_weekly_fact",
    "seller_dim",
    "items_by_order",
    "payments_by_order",
    "pk_conflicts",
    "dedupe_exact",
    "end_to_end_run",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    scratch = tempfile.TemporaryDirectory(prefix="orderflume-")
    spark = build_session(
        "orderflume-bench",
        f"local[{cpus}]",
        **{
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": scratch.name,
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    seconds = {}
    for name in HEADLINE:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(repeats)), 3)
    print(
        json.dumps(
            {
                "metric": "sum of median warm query seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rpartition("sf")[2],
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()
    scratch.cleanup()


if __name__ == "__main__":
    main()
