"""Plan shapes of the registered queries as they would be planned on large
tables: automatic broadcast off (only size-checked hints remain) and the
static plan (AQE off).  Writes PLANS.md.

Usage: python tools/plan_report.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from filing_release.plans.queries import QUERIES  # noqa: E402
from filing_release.session import local_session  # noqa: E402


def shape(plan: str) -> dict:
    return {
        "shuffles": len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|"
                                   r"Exchange RoundRobin|Exchange SinglePartition", plan)),
        "reused": plan.count("ReusedExchange"),
        "smj": plan.count("SortMergeJoin"),
        "bhj": plan.count("BroadcastHashJoin"),
        "agg": len(re.findall(r"(Hash|Sort|ObjectHash)Aggregate\(", plan)),
        "window": plan.count("Window ["),
        "scans": plan.count("FileScan parquet"),
        "pushed": len(re.findall(r"PushedFilters: \[[^\]]*(GreaterThan|LessThan|EqualTo|In\()", plan)),
        "python": plan.count("EvalPython"),
        "cartesian": plan.count("CartesianProduct") + plan.count("BroadcastNestedLoopJoin"),
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = local_session(8)
    rows = []
    from filing_release.plans import queries as q
    from filing_release.plans import release as rel
    from filing_release.sources import driver_tables as dt
    stages = {
        "(stage) base filings": lambda sp, d: dt.base(sp, d, min_year=dt.RELEASE_YEAR - 2),
        "(stage) prior release": lambda sp, d: dt.base_years(sp, d).filter("FISYR = 1999"),
        "(stage) validated release": rel.validated,
        "(stage) reviewed table": q._adjusted_plan,
    }
    items = [(n, fn) for n, (fn, _s) in QUERIES.items()] + list(stages.items())
    for name, fn in items:
        if only and name not in only:
            continue
        df = fn(spark, sf)        # stats passes run here, with the session's normal settings
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        plan = df._jdf.queryExecution().executedPlan().toString()
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        rows.append((name, shape(plan)))
    cols = ["shuffles", "reused", "smj", "bhj", "agg", "window", "scans", "pushed", "python", "cartesian"]
    out = ["# Plan shapes at scale", "",
           "Generated by `tools/plan_report.py`. Automatic broadcast is off and AQE is off, so these are",
           "the static plans for large tables.",
           "",
           "- `bhj` counts only the size-checked or constant-size broadcasts the library hints.",
           "- `shuffles` counts exchanges that must run; `reused` counts exchanges read a second time.",
           "- `scans` counts parquet scans, including staged stages read back.",
           "- `pushed` counts scans with pushed range or equality predicates.",
           "- `python` counts Python evaluation nodes, which must be 0.",
           "",
           "Several queries start from staged parquet (base filings, prior releases, the validated",
           "release, the reviewed table), so their plans begin at that stage. The `(stage)` rows at the",
           "end show the plans that build those stages.", "",
           "| query | " + " | ".join(cols) + " |", "| --- |" + " --- |" * len(cols)]
    for name, s in rows:
        out.append(f"| `{name}` | " + " | ".join(str(s[c]) for c in cols) + " |")
    if only:
        print("\n".join(out))
        return
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out) + "\n")
    print("\n".join(out))


if __name__ == "__main__":
    main()
