"""Bench: headline queries at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS]; median of 3 timed runs after one warm-up, each run fully
materialised (``noop`` write, no collect).  Prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from eventide.plans import QUERIES  # noqa: E402
from eventide.session import get_session  # noqa: E402

HEADLINE = [
    "hot_items",
    "hot_items_sql",
    "hot_urls",
    "pv_sliding",
    "uv_sliding",
    "uv_hashed_bitmap",
    "marketing_by_channel",
    "word_count",
    "left_join_3way_count",
    "order_reconcile",
    "order_timeout",
    "gated_forward",
    "login_fail_timer",
    "seq3_fail",
    "seq2_timeout",
    "temp_jump",
    "rising_run_alert",
    "rolling_sum",
    "allowed_lateness",
    "early_fire_counts",
]


def run(spark, name: str, sf: str) -> float:
    t = time.perf_counter()
    QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = get_session(app="eventide-bench")
    out, failed = {}, {}
    for name in names:
        try:
            run(spark, name, sf)  # warm-up
            out[name] = round(statistics.median(run(spark, name, sf) for _ in range(reps)), 3)
        except Exception as ex:  # noqa: BLE001 - report and keep measuring the rest
            failed[name] = f"{type(ex).__name__}: {str(ex)[:200]}"
    result = {
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(out.values()), 3),
        "unit": "sec",
        "queries": out,
        "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
        "cpus": os.environ.get("BENCH_CPUS", "*"),
    }
    if failed:
        result["failed"] = failed
    print(json.dumps(result))


if __name__ == "__main__":
    main()
