"""Summarise the physical plan of every registered query: exchanges,
joins, windows, Python evaluation, generators and pushed filters."""

from __future__ import annotations

import re
import sys

sys.path.insert(0, ".")
from sluice.plans.registry import QUERIES  # noqa: E402
from sluice.session import build_session  # noqa: E402

FLAGS = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
         "FlatMapGroupsInPandas", "Window", "SortAggregate", "ObjectHashAggregate",
         "BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "ReusedExchange", "Generate",
         "Expand"]


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session()
    for n in names:
        df = QUERIES[n](spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        ex = re.findall(r"Exchange (\w+)", plan)
        single = plan.count("SinglePartition")
        flags = {f: plan.count(f) for f in FLAGS if f in plan}
        rs = re.findall(r"ReadSchema: struct<([^>]*)>", df._jdf.queryExecution().executedPlan().treeString())
        print(f"{n:24} exchanges={len(ex)} single={single} {flags}")


if __name__ == "__main__":
    main()
