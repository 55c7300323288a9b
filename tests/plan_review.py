"""Physical-plan review of registered queries (run after the plan executed,
so AQE's final plan is shown).

Usage: python tests/plan_review.py [sf_dir] [key ...]
Prints, per query: exchanges (shuffles), broadcast / sort-merge joins,
window group limits (partial + final), aggregate kinds, scans with their
pushed filters and read schema.
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

OPS = ["Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange RoundRobinPartitioning",
       "Exchange SinglePartition", "BroadcastExchange", "BroadcastHashJoin", "SortMergeJoin",
       "BroadcastNestedLoopJoin", "CartesianProduct", "WindowGroupLimit", "HashAggregate",
       "ObjectHashAggregate", "SortAggregate", "TakeOrderedAndProject", "ReusedExchange",
       "ArrowEvalPython", "BatchEvalPython", "FlatMapGroupsInPandas", "MapInPandas"]


def review(df) -> dict:
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    c = Counter()
    for op in OPS:
        c[op] = len(re.findall(re.escape(op), plan))
    scans = re.findall(r"FileScan parquet [^\n]*", plan)
    pushed = sorted({m for s in scans for m in re.findall(r"PushedFilters: \[[^\]]*\]", s)})
    return {"ops": {k: v for k, v in c.items() if v}, "scans": len(scans), "pushed": pushed[:6]}


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    import __spark_entry__ as E
    from shelfspark.session import build_session
    spark = build_session("local[8]", 16)
    q = E.queries()
    for k in argv[2:] or sorted(q):
        r = review(q[k](spark, sf_dir))
        print(k, r, flush=True)


if __name__ == "__main__":
    main(sys.argv)
