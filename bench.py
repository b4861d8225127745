"""Benchmark: wall time of the registered queries on one data set.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 1), BENCH_WARMUP (default 1: one untimed pass over all
queries), BENCH_QUERIES (comma list, default: every query of the library; those
of the training-data operators are measured by their own check, see README).

Each query is executed in full with the ``noop`` sink (no rows cross to the
driver).  Timings are warm: one untimed pass first, then a query's time is the
median of the repeats; ``value`` is the sum of the medians.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans.registry import load_all  # noqa: E402
from tidemark.session import build_session  # noqa: E402


def main() -> int:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "1")))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or sorted(load_all()[0])
    spark = build_session(f"local[{cpus}]", app_name="tidemark-bench", shuffle_partitions=max(cpus, 8),
                          extra={"spark.driver.memory": "16g"})
    queries, _ = load_all()
    names = [n for n in names if n in queries]

    if int(os.environ.get("BENCH_WARMUP", "1")):
        for name in names:
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        samples = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus, "repeat": repeat}))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
