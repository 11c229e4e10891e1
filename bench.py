"""Benchmark the headline reconciliation queries.

Runs on ``local[$BENCH_CPUS]`` against ``$BENCH_SF_DIR`` (default
``/root/testdata/sf0.1``) and prints one JSON line.  Each query is forced to
completion with the ``noop`` sink (full evaluation, no driver collect); the
value per query is the median of ``$BENCH_REPS`` runs after one warm-up.
Building the movement snapshot from the given tables (the stand-in for the
hot table) is timed once, separately, as ``load_snapshot``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from movrec.plans.catalog import PLANS  # noqa: E402
from movrec.session import local_session  # noqa: E402
from movrec.sources.fixtures import fixture_snapshot  # noqa: E402

HEADLINE = (
    "match_requests",
    "match_windows",
    "mark_reposted_apply",
    "request_leg_delete",
    "park_unmatched",
    "release_parked",
    "archive_rows",
    "purge_archived",
)


def run_once(spark, name, sf_dir):
    t = time.perf_counter()
    PLANS[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    names = sys.argv[1:] or list(HEADLINE)
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2, app="movrec-bench")
    t = time.perf_counter()
    fixture_snapshot(spark, sf_dir).write.format("noop").mode("overwrite").save()
    setup = time.perf_counter() - t
    results, errors = {}, {}
    for n in names:
        try:
            run_once(spark, n, sf_dir)
            results[n] = round(statistics.median(run_once(spark, n, sf_dir) for _ in range(reps)), 3)
        except Exception as e:  # report the failure, keep benchmarking the rest
            results[n] = None
            errors[n] = f"{type(e).__name__}: {str(e)[:200]}"
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {
        "metric": "total_headline_query_seconds",
        "value": round(sum(v for v in results.values() if v is not None), 3),
        "unit": "sec",
        "queries": results,
        "load_snapshot": round(setup, 3),
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
