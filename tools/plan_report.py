"""Physical-plan summary of every registered query (final adaptive plans).

usage: python tools/plan_report.py [sf_dir] > PLANS.md
Counts shuffle exchanges, broadcasts, join kinds and windows, and shows the
pushed filters / read schema of the scans.
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ventilake import catalog  # noqa: E402
from ventilake.session import build_session  # noqa: E402


def summarize(plan: str) -> dict[str, int]:
    return {
        "shuffles": len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "reused": plan.count("ReusedExchange"),
        "bhj": plan.count("BroadcastHashJoin"),
        "smj": plan.count("SortMergeJoin"),
        "windows": len(re.findall(r"\bWindow \[", plan)),
        "python": int("Python" in plan or "ArrowEval" in plan),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    flagship = "household_balance"
    spark = build_session("local[8]")
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ventilake-"))  # one machine
    print(f"# Physical plans ({sf_dir}, final adaptive plans)\n")
    print("Generated by `python tools/plan_report.py`.  `shuffles` counts hash/range exchanges")
    print("(including the small ones after map-side partial aggregation), `broadcasts` the")
    print("broadcast exchanges of size-checked small sides.\n")
    print("| query | shuffles | broadcasts | reused | BHJ | SMJ | windows | python |")
    print("|---|---|---|---|---|---|---|---|")
    flagship_plan = ""
    for name, fn in catalog.queries().items():
        df = fn(spark, sf_dir)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = plan.split("== Initial Plan ==")[0]  # keep the final adaptive plan only
        s = summarize(plan)
        print(f"| {name} | {s['shuffles']} | {s['broadcasts']} | {s['reused']} | {s['bhj']} | {s['smj']} | {s['windows']} | {s['python']} |")
        if name == flagship:
            flagship_plan = plan
    print(f"\n## Flagship `{flagship}`: exchanges, joins, windows and scans\n")
    print("```")
    for line in flagship_plan.splitlines():
        if re.search(r"Exchange|Join|Window \[|FileScan|HashAggregate", line):
            line = re.sub(r"#\d+L?", "", line)
            print(line[:190])
    print("```")
    spark.stop()


if __name__ == "__main__":
    main()
