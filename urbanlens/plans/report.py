"""Condensed physical plans of the catalogue queries (for PLANS.md).

``python -m urbanlens.plans.report [sf_dir]`` prints, per query, the operator
tree of ``explain("formatted")`` with each scan's pushed filters and read
schema.  Queries that write scratch files do so while being planned.
"""

from __future__ import annotations

import re
import sys

from urbanlens.plans.catalog import QUERIES
from urbanlens.plans.inspect import physical_plan


def condensed(plan: str) -> str:
    lines = plan.splitlines()
    tree, details = [], []
    in_tree = False
    current = None
    for line in lines:
        if line.startswith("== Physical Plan =="):
            in_tree = True
            continue
        if in_tree:
            if not line.strip():
                in_tree = False
                continue
            tree.append(line)
            continue
        header = re.match(r"^\((\d+)\) (.*?)\s*$", line)
        if header:
            kind = header.group(2)
            keep = re.match(r"(Scan \S+|.*Join.*|Exchange|BroadcastExchange|MapInPandas|ArrowEvalPython)", kind)
            current = f"({header.group(1)}) {kind}" if keep else None
        elif current and line.startswith(("PushedFilters", "ReadSchema", "Arguments", "Join type")):
            details.append(f"{current}: {line.strip()}")
    return "\n".join(tree + [""] + details)


def main(sf_dir: str = "/root/testdata/sf0.01") -> None:
    from urbanlens.session import get_session

    spark = get_session(master="local[4]", shuffle_partitions=8)
    for name, query in QUERIES.items():
        print(f"### {name}\n\n```\n{condensed(physical_plan(query(spark, sf_dir)))}\n```\n")


if __name__ == "__main__":
    main(*sys.argv[1:])
