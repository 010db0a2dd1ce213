"""Write docs/PLANS.md: the physical plan tree of every registered batch query
at sf0.01. Usage: python tools/plans.py [sf_dir]"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shoplens.plans.registry import QUERIES  # noqa: E402
from shoplens.session import build_spark  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_spark()
    out = ["# Physical plans", "",
           f"Physical plans as Spark plans them on `{sf_dir}` (`local[8]`, 8 shuffle partitions; "
           "AQE may still coalesce partitions, switch joins or split skew at runtime), generated "
           "by `tools/plans.py`. `Exchange` is a shuffle; `BroadcastExchange` a broadcast; "
           "`WindowGroupLimit` a top-n cut before / after a shuffle.", ""]
    for name, fn in QUERIES.items():
        if name.startswith("stream_"):
            continue
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        tree = "\n".join(line for line in plan.splitlines() if line.strip())
        tree = re.sub(r"#\d+L?", "", tree)
        tree = "\n".join(ln if len(ln) < 200 else ln[:197] + "..." for ln in tree.splitlines())
        out += [f"## {name}", "", "```", tree, "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs",
                        "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(out))
    spark.stop()
    print(path)


if __name__ == "__main__":
    main()
