"""Physical plan summary per query: exchanges (shuffles), broadcast and
sort-merge joins, window operators, group limits, Python stages, and what
each Parquet scan reads and pushes down.

usage: python tools/plans.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from eventide.plans import QUERIES  # noqa: E402
from eventide.session import get_session  # noqa: E402


def summary(plan: str) -> dict:
    return {
        "exchanges": len(re.findall(r"\bExchange hashpartitioning|\bExchange RoundRobin|\bExchange SinglePartition|\bExchange rangepartitioning", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "smj": plan.count("SortMergeJoin"),
        "bhj": plan.count("BroadcastHashJoin"),
        "windows": len(re.findall(r"\bWindow \[", plan)),
        "group_limits": plan.count("WindowGroupLimit"),
        "python": len(re.findall(r"ArrowEvalPython|FlatMapGroupsInPandas|FlatMapCoGroupsInPandas|MapInPandas|PythonMapInArrow", plan)),
        "scans": [
            f"{m.group(2)}[{re.sub(r'#[0-9]+L?', '', m.group(1))}] pushed[{re.sub(r'#[0-9]+L?', '', m.group(3))}]"
            for m in re.finditer(
                r"FileScan parquet \[([^\]]*)\].*?/(\w+)\.parquet\].*?PushedFilters: \[([^\]]*)\]", plan
            )
        ],
    }


def main() -> None:
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    names = [a for a in args if not a.startswith("/")] or HEADLINE
    spark = get_session(app="eventide-plans")
    for n in names:
        plan = QUERIES[n](spark, sf)._jdf.queryExecution().executedPlan().toString()
        s = summary(plan)
        scans = "; ".join(s.pop("scans"))
        print(f"| {n} | " + " | ".join(str(v) for v in s.values()) + f" | {scans} |")


if __name__ == "__main__":
    main()
