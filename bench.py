"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (tables), BENCH_CPUS (cores), BENCH_RUNS (timed runs after one warm-up; the median
counts) and BENCH_QUERIES (comma-separated names, or ``all``) may be set.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ridelake.queries import QUERIES  # noqa: E402
from ridelake.session import local_session  # noqa: E402

HEADLINE = (
    "silver_table",
    "dedupe_latest",
    "hourly_stats",
    "daily_stats",
    "zone_pair_stats",
    "driver_patterns",
    "tumbling_5m",
    "sliding_15m_5m",
    "session_30m",
    "session_global",
    "rolling_mean",
    "running_vendor_stats",
    "ride_anomalies_batch",
    "zscore_flag",
    "asof_join",
    "multi_view_join",
    "lookup_latest",
    "expected_fare_ratio",
    "describe",
    "histogram",
    "box_summary",
    "iqr_outliers",
    "correlation_matrix",
    "data_quality_report",
    "drift_report",
    "split_stratified",
    "classification_report",
    "upsert",
    "stream_tumbling_5m",
)


def timed(spark, name: str, folder: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    asked = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if asked == "all" else [n for n in asked.split(",") if n] or list(HEADLINE)
    spark = local_session(cpus, os.environ.get("BENCH_MEMORY", "16g"), "ridelake-bench")
    seconds = {}
    for name in names:
        timed(spark, name, folder)
        seconds[name] = round(statistics.median(timed(spark, name, folder) for _ in range(runs)), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
