"""Write PLANS.md: the final (adaptive) physical plan of every registered query.

Usage: python tools/plan_report.py [SF_DIR] [OUT]

Each query runs once with the noop sink so that adaptive decisions (broadcast
conversions, coalesced partitions) appear; the plan is condensed to operator
names with their keys.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.plans.catalog import QUERIES  # noqa: E402
from tessera.session import local_session  # noqa: E402

KEEP = ("Exchange", "QueryStage", "AQEShuffleRead", "Join", "Scan", "Aggregate", "Window", "Sort ", "MapInPandas",
        "Generate", "BroadcastExchange", "Limit", "Union", "Expand", "Filter", "Project")


def condense(plan: str) -> list[str]:
    out = []
    for line in plan.splitlines():
        if not any(k in line for k in KEEP):
            continue
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r", \[plan_id=\d+\]", "", line)
        line = re.sub(r"Location: InMemoryFileIndex\([^)]*\)\[[^\]]*\]", "", line)
        if "Project [" in line or "Filter " in line:
            line = line[: line.index("[") + 1] + "...]" if "[" in line else line
        out.append(line[:160].rstrip())
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    out_path = sys.argv[2] if len(sys.argv) > 2 else "PLANS.md"
    spark = local_session(cores=8, shuffle_partitions=8)
    lines = ["# Physical plans", "",
             f"Final adaptive plans of the registered queries on `{sf_dir}` (local[8]),",
             "condensed to operators. Regenerate with `python tools/plan_report.py`.", ""]
    for name, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        df.collect()                      # runs this very query execution
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        cond = condense(plan)
        n_ex = sum(1 for c in cond if "Exchange hashpartitioning" in c or "Exchange rangepartitioning" in c
                   or "Exchange SinglePartition" in c)
        joins = sorted({m for c in cond for m in re.findall(r"(\w+Join)\b", c)})
        lines += [f"## {name}", "",
                  f"shuffles: {n_ex}; joins: {', '.join(joins) or 'none'}", "", "```"]
        lines += cond + ["```", ""]
    spark.stop()
    with open(out_path, "w") as f:
        f.write("\n".join(lines) + "\n")


if __name__ == "__main__":
    main()
