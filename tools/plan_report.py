"""Per-query physical-plan summary: shuffles, broadcasts, join strategies,
partial aggregation, Python evaluation.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md

Two columns of plans: the default (size-checked broadcast) and "no
broadcast" - the shape a 100 TB run takes when the employee-sized tables
exceed the broadcast threshold.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stridelake.plans.catalog import REGISTRY  # noqa: E402
from stridelake.session import build_session  # noqa: E402

KEYS = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")


def summary(plan: str) -> str:
    shuffles = len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition",
                              plan))
    bcast = plan.count("BroadcastExchange")
    joins = sorted(set(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|"
                                  r"CartesianProduct)[^\n]*?(Inner|LeftOuter|LeftAnti|LeftSemi|FullOuter|RightOuter)",
                                  plan)))
    joins_txt = ", ".join(f"{j}/{t}" for j, t in joins) or "-"
    partial = "yes" if "partial_" in plan else "-"
    py = "YES" if ("BatchEvalPython" in plan or "ArrowEvalPython" in plan) else "no"
    return f"{shuffles} | {bcast} | {joins_txt} | {partial} | {py}"


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    print("| query | plan | shuffles | broadcasts | joins | partial agg | Python |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    for name, fn in REGISTRY.items():
        for label, value in (("default", None), ("no broadcast", "-1")):
            old = [spark.conf.get(k) for k in KEYS]
            if value:
                for k in KEYS:
                    spark.conf.set(k, value)
            try:
                plan = fn(spark, sf)._jdf.queryExecution().executedPlan().toString()
            finally:
                for k, v in zip(KEYS, old):
                    spark.conf.set(k, v)
            print(f"| `{name}` | {label} | {summary(plan)} |")
    spark.stop()


if __name__ == "__main__":
    main()
