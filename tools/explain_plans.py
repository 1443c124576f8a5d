"""Condensed executed plans (AQE final plans) of the headline queries.

Usage: python tools/explain_plans.py [sf_dir] > docs/PLANS.md
Keeps the operators that decide cost at scale: scans (with their read schema),
exchanges, joins, aggregates, windows, unions, checkpointed inputs and reuse.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lapworks.plans import suite  # noqa: E402
from lapworks.session import build_session  # noqa: E402

NAMES = ["driver_leaderboard", "driver_leaderboard_distributed", "lap_progression_distributed",
         "lap_progression_hot_driver",
         "enrich_hot_split", "dense_rank_distributed", "pace_median_distributed", "dq_results_laps",
         "pace_gap", "rest_source"]
KEEP = re.compile(r"(Exchange|Join|Aggregate|Window|Union|Scan|Reused|Sort \[|TakeOrdered|MapInPandas|Subquery)")


def condensed(plan: str) -> list[str]:
    body = plan.split("== Final Plan ==")[1].split("== Initial Plan ==")[0] if "== Final Plan ==" in plan else plan
    out = []
    for line in body.splitlines():
        if KEEP.search(line):
            line = re.sub(r"#\d+L?", "", line)
            line = re.sub(r", \[plan_id=\d+\]", "", line)
            line = re.sub(r"Location: [^,]*, ", "", line)
            line = re.sub(r"DataFilters: \[[^\]]*\]?[^,]*, ", "", line)
            out.append(line.rstrip()[:170])
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(shuffle_partitions=8)
    print("# Executed plans (condensed)\n")
    print(f"Generated by `tools/explain_plans.py {sf_dir}` (AQE final plans, local[*], 8 shuffle partitions).")
    print("Only scans, exchanges, joins, aggregates, windows, unions and reuse markers are kept.\n")
    for name in NAMES:
        df = suite.QUERIES[name](spark, sf_dir)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"## {name}\n\n```")
        print("\n".join(condensed(plan)))
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main()
