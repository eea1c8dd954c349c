"""Benchmark: run the headline release queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), BENCH_QUERIES (comma list, default the headline set),
BENCH_WARMUP_DIR (default the sibling sf0.001 folder).  Each query's full
plan is executed into Spark's ``noop`` sink (no collect).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from filing_release.plans.queries import QUERIES  # noqa: E402
from filing_release.session import local_session  # noqa: E402

HEADLINE = ["dedup_best", "enrich_left_join", "classify_level3", "money_full", "prior_year",
            "backfill_cascade", "dedup_year_shift", "residuals_wide", "rule_failure_summary",
            "largest_rows", "review_reasons", "apply_fixes", "apply_adjustments", "review_state",
            "field_line_lookup", "audit_counts"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = local_session(cpus, shuffle_partitions=max(8, cpus * 2), app="filing_release_bench")
    # warm-up (not timed): one pass of the first query over the smallest data
    # set loads classes and JIT-compiles the scan/join/aggregate code paths,
    # as on a long-running cluster
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", os.path.join(os.path.dirname(sf_dir), "sf0.001"))
    if os.path.isdir(warm_dir) and os.path.abspath(warm_dir) != os.path.abspath(sf_dir):
        QUERIES[names[0]][0](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    t_all = time.time()
    for n in names:
        fn = QUERIES[n][0]
        t = time.time()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.time() - t, 3)
    total = round(time.time() - t_all, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "release_queries_total", "value": total, "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir,
                      "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
