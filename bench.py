"""Bench: headline queries on $BENCH_SF_DIR (default /root/testdata/sf0.1)
on local[$BENCH_CPUS]; prints ONE JSON line.

Each query is built and executed to a no-op sink (full evaluation, no
collect).  One warm-up pass on the smallest scale factor runs first so JVM
start-up and first-time class loading are not charged to a query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "route_outcomes",
    "to_dead_letters",
    "user_contract_errors",
    "upsert_latest",
    "current_users",
    "dlq_stats_all",
    "replay_plan",
    "rate_per_second",
    "duration_quantiles",
    "stream_users",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from tollgate.plans.catalog import spark_entry_queries
    from tollgate.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="tollgate-bench")
    qs = spark_entry_queries()
    warm = "/root/testdata/sf0.001"
    if os.path.isdir(warm):
        for name in ("route_outcomes", "dlq_stats_all"):
            qs[name](spark, warm).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
