"""Benchmark of the headline queries.

Runs at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]
and prints one JSON line.  Inputs that stand for existing state (landed API
pages, the site config, the table a run merges into) are materialized once
before timing, as they exist before a run in production; each timed query
then executes completely into Spark's ``noop`` sink (no driver collection).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "sync_full",          # R1: one site's full run
    "sync_all",           # R4: every enabled site in one plan
    "merge_upsert",       # K3: MERGE into a target of about the same size
    "normalize_status",   # J2: broadcast status lookup over all rows
    "dedup_latest",       # W1
    "flatten_woocommerce",  # P1
    "flatten_gomag",        # P2
    "flatten_merchantpro",  # P3
]


def main() -> None:
    from shopfold.plans.catalog import registry
    from shopfold.plans import fixture as fx
    from shopfold.plans.catalog import merge_target
    from shopfold.plans.q_runs import run_target
    from shopfold.session import build_session
    from shopfold.sources.landing import land_pages

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", int(cpus))
    spark.conf.set("spark.sql.shuffle.partitions", str(int(cpus) * 2))

    # Warm-up on the smallest data set: JIT and the generated-code cache are
    # per-process, as on a long-running cluster; excluded from the timings.
    t0 = time.time()
    small = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    qs0 = registry()
    if os.path.isdir(small) and small != sf_dir:
        for name in HEADLINE:
            qs0[name](spark, small).write.format("noop").mode("overwrite").save()
    warm = time.time() - t0

    t0 = time.time()
    land_pages(spark, sf_dir)
    fx.pages(spark, sf_dir)   # lists the landing once per session
    fx.sites(spark, sf_dir).count()
    fx.mappings(spark, sf_dir).count()
    merge_target(spark, sf_dir).count()
    run_target(spark, sf_dir).count()
    prep = time.time() - t0

    qs = registry()
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in qs]
    times = {}
    for name in names:
        t = time.time()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t, 3)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_wall", "value": total, "unit": "sec",
                      "queries": times, "sf": sf, "prep_sec": round(prep, 3),
                      "warmup_sec": round(warm, 3),
                      "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
