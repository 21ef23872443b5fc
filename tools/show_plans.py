"""Write PLANS.md: physical-plan trees of the headline queries.

usage: python tools/show_plans.py [sf_dir]   (default /root/testdata/sf0.1)
Shown is the physical plan before adaptive re-planning (AQE may still turn
a sort-merge join whose measured side is small into a broadcast, coalesce
partitions or split skewed ones at run time).
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

QUERIES = ("driver_standings", "latest_result_by_snapshot", "upsert_single_key",
           "upsert_update_list", "race_results")


def tree(df) -> str:
    text = df._jdf.queryExecution().executedPlan().treeString()
    keep = []
    for line in text.splitlines():
        line = line.split(" [", 1)[0] if "Scan parquet" not in line else line
        if "FileScan parquet" in line:
            head, _, rest = line.partition("FileScan parquet")
            cols = rest.split("]", 1)[0] + "]"
            pushed = rest.split("PushedFilters: ", 1)[1].split("]", 1)[0] + "]" \
                if "PushedFilters: " in rest else ""
            line = f"{head}FileScan parquet {cols} PushedFilters: {pushed}"
        keep.append(line.rstrip())
    return "\n".join(keep)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from lapmart.plans import contract
    from lapmart.session import local_session

    spark = local_session(8)
    out = ["# Physical plans (before adaptive re-planning, sf0.1, local[8])", "",
           "Generated by `tools/show_plans.py`; expressions trimmed, scans show the",
           "read columns and pushed filters.", ""]
    for name in QUERIES:
        df = contract.QUERIES[name](spark, sf_dir)
        out += [f"## {name}", "", "```", tree(df), "```", ""]
    spark.stop()
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                           "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
