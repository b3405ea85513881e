"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; print one JSON line.

Each query is fully evaluated with the no-op sink (every row computed, nothing
collected to the driver).  ``BENCH_EVENT_LOG=<folder>`` also writes Spark's event
log there, for stage and task times.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tally.plans.catalog import QUERIES  # noqa: E402
from tally.session import get_session  # noqa: E402

HEADLINE = [
    "payables", "receivables", "contacts",
    "conform_payables", "conform_contacts", "impute_accounts",
    "error_summary", "violations_sample5",
    "adaptive_granularity", "est_month_parts", "part_manifest", "row_parts",
    "recursive_parts", "date_split", "recursive_parts_small_limit", "date_split_small_limit",
    "verify_sums", "pk_duplicates", "fk_orphans", "not_null_audit",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    extra = {"spark.driver.memory": "16g"}
    event_dir = os.environ.get("BENCH_EVENT_LOG")   # optional: stage/task times for offline reading
    if event_dir:
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_dir,
                      "spark.eventLog.compress": "false"})
    spark = get_session(f"local[{cpus}]", app="tally-bench", shuffle_partitions=cpus * 2, extra=extra)
    # JIT warm-up of the main code paths on the smallest tables (not timed)
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    for name in ("payables", "contacts", "est_month_parts", "error_summary"):
        QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else None,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
