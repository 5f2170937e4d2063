"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is planned and executed in full into Spark's no-op sink (every
row computed, nothing collected), once to warm up and then $BENCH_RUNS
times; the per-query figure is the median.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "revenue_by_zone_month", "trips_by_zone_month", "silver_joined", "daily_zone_fact",
    "orders_by_city_month", "star_fact", "star_q1", "star_q2", "star_q3", "allocate_lines",
    "upsert_raw", "incremental_daily", "layout_range", "revenue_by_customer", "test_unique",
    "null_profile", "describe_numeric", "corr_matrix", "duplicate_count", "prep_mixed",
    "split_three", "ols_normal",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    keys = [k for k in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if k]

    from lakeline.plans.registry import load_all
    from lakeline.session import build_session

    spark = build_session(f"local[{cpus}]", 8, "lakeline-bench",
                          {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lakeline-bench-ckpt-"))
    reg = load_all()

    def once(key: str) -> float:
        t0 = time.perf_counter()
        reg[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    results = {}
    for k in keys:
        once(k)  # warm-up: JIT, file listing, Python workers
        results[k] = round(statistics.median(once(k) for _ in range(runs)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(results.values()), 3),
                      "unit": "sec", "queries": results, "sf": sf, "runs": runs, "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
