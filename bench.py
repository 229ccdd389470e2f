"""Benchmark the headline queries; prints ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is run once to warm up, then 3 times; the median is reported.
Results are forced through the ``noop`` sink (full execution, no collect).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["mart_build", "mart_build_pruned", "mart_upsert", "keep_first", "dim_insert_new",
            "portal_filter", "distinct_on", "stg_distinct", "surrogate_ids", "check_unique",
            "mart_latest", "feed_okved"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE

    from dimloom.session import get_session
    from dimloom.plans.queries import QUERIES

    spark = get_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    times, rows = {}, {}
    for name in names:
        def once():
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0
        once()  # warm-up
        times[name] = round(statistics.median(once() for _ in range(runs)), 3)
        rows[name] = QUERIES[name](spark, sf_dir).count()
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    out = {
        "metric": "headline_total_median_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "rows": rows,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "lineitem_rows": lineitem,
        "cpus": int(cpus),
        "spark": spark.version,
        "conf": {k: spark.conf.get(k) for k in (
            "spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled",
            "spark.sql.autoBroadcastJoinThreshold")},
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
