"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is executed in full with the ``noop`` sink (every row computed,
nothing collected). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "decline_table",        # A01-A04, J01, C21-C24
    "snapshot",             # A20-A21, C13-C20
    "feature_vector",       # C01-C10
    "baseline_queue",       # Q01-Q05, W01-W02
    "roc_auc",              # M02
    "precision_at_k",       # M04
    "client_holdout",       # L01
    "final_queue_blend",    # Q06-Q10 (oracle-checked blend)
    "final_queue",          # E01-E10 + Q06-Q10 (three MLlib models)
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "1"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    from panelrank.plans import registry
    from panelrank.session import get_spark
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=int(cpus))
    qs = registry.queries()
    # warm-up (JVM JIT, Python workers) on the smallest fixture, not timed
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm):
        for name in ("decline_table", "baseline_queue"):
            qs[name](spark, warm).write.format("noop").mode("overwrite").save()
    times, errors = {}, {}
    for name in (only or HEADLINE):
        runs = []
        try:
            for _ in range(reps):
                t0 = time.time()
                qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
                runs.append(time.time() - t0)
            times[name] = round(statistics.median(runs), 3)
        except Exception as e:  # keep the one-line contract even if a query fails
            times[name] = None
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "headline_total", "value": round(sum(t for t in times.values() if t is not None), 3),
           "unit": "sec", "queries": times, "sf": sf, "cpus": int(cpus), "reps": reps}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


if __name__ == "__main__":
    main()
