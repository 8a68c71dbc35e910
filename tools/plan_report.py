"""Physical-plan summary of the warehouse queries (plans only, nothing runs).

usage: python tools/plan_report.py [sf_dir]

Counts scans, shuffles (exchanges), reuses of one, broadcasts and JSON parses, and flags operators that do not
scale: cartesian products, nested-loop joins, single-partition exchanges and
row-at-a-time or Arrow Python evaluation.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shoal.plans.reports import REGISTRY  # noqa: E402
from shoal.session import build_session  # noqa: E402

FLAGS = ("CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition", "BatchEvalPython",
         "ArrowEvalPython")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session(master="local[2]")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # shows exchanges that are used again
    print("| query | scans | shuffles | reused | broadcasts | parses | flags |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    for name, fn in REGISTRY.items():
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        shuffles = len(re.findall(r"Exchange (hashpartitioning|RoundRobinPartitioning|"
                                  r"rangepartitioning|SinglePartition)", plan))
        scans = plan.count("FileScan")
        parses = plan.count("parseJson(") + plan.count("from_json(")
        flags = [f for f in FLAGS if f in plan]
        print(f"| `{name}` | {scans} | {shuffles} | {plan.count('ReusedExchange')} | {plan.count('BroadcastExchange')} | "
              f"{parses} | {', '.join(flags) or 'none'} |")
    spark.stop()


if __name__ == "__main__":
    main()
