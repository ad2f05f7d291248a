"""Benchmark: run the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query is fully executed with the no-op sink (every row produced, nothing sent to
the driver).  Two passes over the same queries: the first (cold: class loading, code
generation) and the second (warm, steady state).  ``value`` / ``queries`` report the
warm pass; ``cold_total`` / ``cold_queries`` the first.  Nothing is cached between
passes: every run re-reads the parquet tables.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "trusted_features", "star_enrich", "clean_05", "clean_summary", "null_audit", "distinct_counts",
    "numeric_stats", "profile_long", "metadata_document", "correlation", "histogram_auto", "histogram_by_label",
    "density_curve", "auc_exact", "roc_curve", "metrics_report", "split_hash", "minmax_scale",
    "histograms_numeric", "clean_zone_counts", "cv_metrics",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from ridgeline.registry import QUERIES
    from ridgeline.session import local_session

    spark = local_session(cpus=cpus, app="ridgeline-bench", memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    passes = []
    for _ in range(2):
        times = {}
        for name in HEADLINE:
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
        passes.append(times)
    cold, warm = passes
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "cold_total": round(sum(cold.values()), 3),
        "cold_queries": cold,
    }))


if __name__ == "__main__":
    main()
