"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs to completion through the no-op sink (every row computed,
nothing collected), three times; the median is reported.  Prints one JSON
line: {"metric", "value" (sum of medians), "unit", "queries", "sf"}.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from eventrollup.registry import QUERIES  # noqa: E402
from eventrollup.session import get_session  # noqa: E402

HEADLINE = (
    "batch_view",            # A6 multi-grain roll-up of events
    "batch_view_lineitem",   # A6 on the largest table
    "count_by_period",       # Q1 over batch + speed, reference cut-over
    "get_events_all",        # Q4 catalogue semi join + cover rows
    "merge_batch_speed",     # J1
    "count_many_ranges",     # X5 one request per event row
    "master_dataset",        # landing JSON -> master Parquet -> counts
    "speed_view",            # Structured Streaming foreachBatch partials
    "upsert_batch_view",     # conditional upsert, three rounds
    "batch_refresh",         # two landing drops, incremental ingest and recount
    "speed_view_tiered",     # eight drops, one stored twice, tiers merged
    "upsert_merge_on_read",  # five upserts as deltas, folded, vacuumed
    "count_many_ranges_default_cut",  # X5, each request with its own cut
)
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(f"local[{cpus}]", int(cpus), app_name="eventrollup-bench")
    # Warm the JVM (class loading, codegen caches) outside the timings.
    QUERIES["count_minute"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    timings = {}
    for key in HEADLINE:
        runs = []
        for _ in range(RUNS):
            t0 = time.perf_counter()
            QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        timings[key] = round(statistics.median(runs), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
