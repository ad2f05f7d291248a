"""Print the operator shape of the headline queries' physical plans.

Usage: python tools/plans.py [sf_dir] [name ...]
Runs each query once (so the adaptive plan is final) and summarises: scans with their
pushed filters and read schema, exchanges, join strategies, windows, aggregates.
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ridgeline.registry import QUERIES  # noqa: E402
from ridgeline.session import local_session  # noqa: E402

KEEP = ("Exchange", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin",
        "BroadcastNestedLoopJoin", "CartesianProduct", "Window", "Expand", "Generate",
        "HashAggregate", "ObjectHashAggregate", "SortAggregate", "Subquery", "ReusedExchange",
        "ReusedSubquery", "AQEShuffleRead")


def final_part(plan: str) -> str:
    """Keep the final adaptive plans (the initial plans are printed after them)."""
    return "\n".join(part.split("== Initial Plan ==")[0] for part in plan.split("== Final Plan ==")[1:]) or plan


def summarise(df) -> str:
    sc = df.sparkSession.sparkContext
    group = f"plans-{id(df)}"
    sc.setJobGroup(group, group)
    rows = df.collect()  # runs this DataFrame's own adaptive plan to completion
    jobs = len(sc.statusTracker().getJobIdsForGroup(group))
    sc.setJobGroup("other", "other")
    plan = final_part(df._jdf.queryExecution().executedPlan().toString())
    ops = Counter()
    ops["distinct subqueries"] = len(set(re.findall(r"subquery#(\d+)", plan)))
    ops["jobs"] = jobs
    for line in plan.splitlines():
        m = re.search(r"([A-Z][A-Za-z]+)", line)
        if m and m.group(1) in KEEP:
            ops[m.group(1)] += 1
    smj_skew = plan.count("skew=true")
    scans = sorted(set(re.findall(r"FileScan parquet [^\[]*\[([^\]]*)\][^\n]*?PushedFilters: (\[[^\]]*\])", plan)))
    out = [f"rows={len(rows)} ops={dict(ops)}" + (f" skew-split joins={smj_skew}" if smj_skew else "")]
    for cols, pushed in scans[:8]:
        out.append(f"    scan [{cols[:90]}] pushed {pushed[:120]}")
    return "\n".join(out)


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    names = [a for a in args if not a.startswith("/")] or [
        "trusted_features", "clean_05", "clean_summary", "null_audit", "distinct_counts", "correlation",
        "histogram_auto", "density_curve", "auc_exact", "roc_curve", "metrics_report"]
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    for n in names:
        print(f"{n}: {summarise(QUERIES[n](spark, sf_dir))}")


if __name__ == "__main__":
    main()
