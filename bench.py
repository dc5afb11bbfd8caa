"""Benchmark of the headline queries.

Runs each query at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS] and prints ONE JSON line:
{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is executed completely with the ``noop`` sink (every row is
produced, nothing is collected to the driver).  One warm-up query runs first;
each query's time is the best of $BENCH_REPEATS runs (default 2).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "user_features", "destination_features", "asof_lookup", "training_set",
    "feature_lookup_exact", "player_clean", "skill_features", "physical_features",
    "gold_join", "mv_incremental_sum", "stream_table_ingest", "merge_upsert", "snapshot_changes",
    "column_profile", "classify_columns", "drift_metrics", "top_k_with_others",
    "vector_topk", "json_records", "multi_count_distinct", "sum_group_by_all",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from lakeops.registry import QUERIES
    from lakeops.session import build_session

    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2),
                          app_name="lakeops-bench")

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    run("count_all")                                         # warm-up (JVM, class loading)
    times: dict[str, float] = {}
    for name in only or HEADLINE:
        best = min(run(name) for _ in range(max(1, repeats)))
        times[name] = round(best, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
