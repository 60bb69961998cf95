"""Time the headline queries and print one JSON line.

BENCH_SF_DIR: tables to read. BENCH_CPUS: local cores. BENCH_RUNS: timed runs after one warm-up (median is reported).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from cartwheel.plans.queries import QUERIES  # noqa: E402
from cartwheel.session import build_session  # noqa: E402

HEADLINES = [
    "c8_silver_events",
    "c9_event_contract_report",
    "e2_silver_items",
    "u1_user_volume",
    "u6_user_sessions",
    "u11_user_top_categories",
    "u14_user_features",
    "i5_item_distinct_users",
    "i10_item_category_popularity",
    "i13_item_features",
    "t1_tfidf_terms",
    "u13_user_embedding",
    "x2_ui_cooccurrence",
    "x3_ui_session_context",
    "x9_ui_category_affinity",
    "x11_cross_features",
    "r2_rt_user_features",
    "r5_rt_item_popularity_delta",
    "r7_rt_to_online",
    "f5_materialize",
    "f6_point_in_time_join",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINES:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": Path(sf_dir).name}
        )
    )


if __name__ == "__main__":
    main()
