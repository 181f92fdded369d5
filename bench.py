"""Benchmark: run every registered operator at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with the ``noop`` sink (every row produced, nothing sent to
the driver), after one warm-up pass over a few queries to load the JVM code paths; each
operator runs $BENCH_REPEAT times (default 2). Nothing is staged: every run derives the banking tables
from the source files. Prints one JSON line: ``queries`` and ``value`` are the best run of each
(warm; damps the noise of a shared machine), ``cold`` and ``cold_total`` its first run.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyspark.plans.registry import queries  # noqa: E402
from tallyspark.session import local_session  # noqa: E402


def run_once(spark, fn, sf_dir: str) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "2")))
    only = [k for k in os.environ.get("BENCH_QUERIES", "").split(",") if k]
    spark = local_session(cpus, shuffle_partitions=cpus, app="tallyspark-bench")

    qs = queries()
    if only:
        qs = {k: v for k, v in qs.items() if any(k.startswith(p) for p in only)}
    for key in list(qs)[:3]:  # warm-up
        run_once(spark, qs[key], sf_dir)

    times: dict[str, float] = {}
    cold: dict[str, float] = {}
    for key, fn in qs.items():
        runs = [run_once(spark, fn, sf_dir) for _ in range(repeat)]
        times[key], cold[key] = round(min(runs), 3), round(runs[0], 3)
        print(f"{key}: {times[key]}s", file=sys.stderr, flush=True)

    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "total_wall_seconds_all_operators",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "cold_total": round(sum(cold.values()), 3),
        "cold": cold,
        "sf": sf,
        "cpus": cpus,
        "n_queries": len(times),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
