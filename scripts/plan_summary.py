"""Summarise the final physical plan of registered queries (after execution).

Usage: python scripts/plan_summary.py [sf_dir] [name ...]
Prints, per query: exchanges (shuffles), broadcast exchanges, join kinds,
aggregates, windows, scans with the columns each reads, and subqueries.
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.plans.registry import load_all  # noqa: E402
from tidemark.session import build_session  # noqa: E402


def final_part(plan: str) -> str:
    """The plan text without the initial plans, whose subtrees stand below their heading."""
    kept, skip = [], None
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        if skip is not None and depth >= skip:
            continue
        skip = depth if "== Initial Plan ==" in line else None
        if skip is None:
            kept.append(line)
    return "\n".join(kept)


def summarise(plan: str) -> dict:
    c = Counter()
    scans = []
    for line in plan.splitlines():
        s = re.sub(r"^\*\(\d+\) ", "", line.strip(" :+-"))
        if s.startswith("Exchange hashpartitioning") or s.startswith("Exchange SinglePartition") \
                or s.startswith("Exchange rangepartitioning") or s.startswith("Exchange RoundRobin"):
            c["shuffle"] += 1
        elif s.startswith("BroadcastExchange"):
            c["broadcast"] += 1
        for kind in ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin",
                     "CartesianProduct", "HashAggregate", "SortAggregate", "ObjectHashAggregate", "Window",
                     "Generate", "TakeOrderedAndProject", "ReusedExchange", "ReusedSubquery"):
            if s.startswith(kind):
                c[kind] += 1
        if s.startswith("Subquery "):
            c["Subquery"] += 1
        m = re.search(r"FileScan (\w+) \[([^\]]*)\].*?PushedFilters: \[([^\]]*)\]", s)
        if m:
            scans.append((m.group(1), len(m.group(2).split(",")), m.group(3)[:60]))
    return {"ops": dict(c), "scans": scans}


def main() -> int:
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    names = [a for a in args if not a.startswith("/")]
    spark = build_session("local[8]", shuffle_partitions=8)
    queries, _ = load_all()
    for name in names or sorted(queries):
        df = queries[name](spark, sf)
        execution = df._jdf.queryExecution()
        execution.toRdd().count()  # runs this very plan, so it is the one that adaptive execution ended with
        plan = execution.executedPlan().toString()
        info = summarise(final_part(plan))
        scans = ", ".join(f"{fmt}:{n}cols" + (f"[{pf}]" if pf else "") for fmt, n, pf in info["scans"])
        print(f"| {name} | {', '.join(f'{k}={v}' for k, v in sorted(info['ops'].items()))} | {scans} |",
              flush=True)
    spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
