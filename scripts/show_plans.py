"""Print the executed (AQE final) physical plan outline of registered queries.

usage: python scripts/show_plans.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from footfall import registry  # noqa: E402
from footfall.session import local_session  # noqa: E402

DEFAULT = ["visitor_flow_dur", "visitor_flow_home", "residence_table", "resident_anti_join",
           "rolling_step", "district_join", "signal_scan"]
KEEP = re.compile(r"(Exchange|Join|Aggregate|Scan|Sort\b|Window|Union|Generate|Filter|"
                  r"InMemory|Reused|AQEShuffleRead|isFinalPlan)")


def outline(df) -> str:
    # collect() runs the frame's own query execution, so the adaptive plan printed
    # below is the final one (results here are small: sf0.01 by default)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines = []
    for line in plan.splitlines():
        if KEEP.search(line):
            lines.append(re.sub(r"#\d+L?", "", line)[:160])
    return "\n".join(lines)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or DEFAULT
    spark = local_session()
    qs = registry.queries()
    for name in names:
        print(f"### {name}\n\n```\n{outline(qs[name](spark, sf_dir))}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
