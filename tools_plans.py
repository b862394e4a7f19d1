"""Write PLANS.md: the physical plan of every registered query at sf0.1.

For each query: shuffle count, scans with their pruned read schema and
pushed filters, and the operator tree (expressions stripped).
Usage: python tools_plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import re
import sys

from casemill.plans.catalog import QUERIES
from casemill.session import local_session

SKIP = {"stream_intake", "stream_update", "stream_cases", "stream_backfill_compact"}  # building them runs the stream


def summarize(plan: str) -> tuple[list[str], list[str], int]:
    tree, scans = [], []
    for line in plan.split("\n"):
        m = re.match(r"^([\s:+\-*()0-9]*?)([A-Z][A-Za-z]+)", line)
        if not m:
            continue
        name = m.group(2)
        extra = ""
        if "Exchange" in name:
            part = re.search(r"(hashpartitioning\([^)]*\)|SinglePartition|HashedRelationBroadcastMode|IdentityBroadcastMode)", line)
            extra = " " + re.sub(r"#\d+L?", "", part.group(1)) if part else ""
        if name in ("FileScan", "Scan"):
            loc = re.search(r"testdata/sf[0-9.]+/(\w+)\.parquet", line)
            rs = re.search(r"ReadSchema: (struct<[^ ]*)", line)
            pf = re.search(r"PushedFilters: (\[[^\]]*\])", line)
            scans.append(f"{loc.group(1) if loc else '?'}: read {rs.group(1) if rs else '?'}; pushed {pf.group(1) if pf else '[]'}")
            extra = f" {loc.group(1)}" if loc else ""
        tree.append(m.group(1) + name + extra)
    shuffles = sum(1 for t in tree if re.search(r"(^|[\s+\-:])Exchange hashpartitioning|(^|[\s+\-:])Exchange SinglePartition", t))
    return tree, scans, shuffles


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, 16)
    print("# PLANS\n")
    print(f"Physical plans (initial AQE plans) of the registered queries at `{sf}`, generated by `tools_plans.py`.")
    print("Exchange = shuffle; BroadcastExchange = broadcast of a side whose estimated size is under the threshold.")
    print("At runtime AQE may still coalesce partitions, split skewed partitions or switch a sort-merge join to broadcast.\n")
    for name, fn in QUERIES.items():
        if name in SKIP:
            continue
        df = fn(spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        tree, scans, shuffles = summarize(plan)
        print(f"## {name}\n")
        print(f"Shuffles: {shuffles}\n")
        for s in scans:
            print(f"- {s}")
        print("\n```")
        print("\n".join(tree))
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main()
