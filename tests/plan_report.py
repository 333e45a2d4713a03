"""Write PLANS.md: the executed (adaptive, final) plan shape of every
registered query, as planned locally and with broadcasts disabled.

    python tests/plan_report.py [sf_dir] > PLANS.md
    python tests/plan_report.py sf_dir name ...    # rows of some queries only

With broadcasts off, every join is a sort-merge join on shuffled inputs:
the shape the plans take when no side fits in memory (the 100 TB case).
Counts come from ``DataFrame.explain()`` output after the query has run.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

DETAIL = ("diff_rows_fix", "verdict_fix", "diff_cells", "reconcile")


def final_plan(df) -> str:
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue().split("+- == Initial Plan ==")[0]


def counts(plan: str) -> dict:
    c = lambda pat: len(re.findall(pat, plan))
    return {
        # the text of a reused exchange repeats the exchange it reuses
        "shuffles": c(r"Exchange (hash|range)partitioning") - c(r"ReusedExchange[^\n]*Exchange (hash|range)partitioning"),
        "reused": c(r"ReusedExchange"),
        "to one partition": c(r"Exchange SinglePartition"),
        "broadcasts": c(r"BroadcastExchange"),
        "sort-merge joins": c(r"SortMergeJoin"),
        "skew-split joins": c(r"skew=true"),
        "hash aggregates": c(r"HashAggregate\(keys=\[[^\]]"),
        "sort aggregates": c(r"SortAggregate"),
        "nested-loop or cartesian": c(r"NestedLoopJoin|CartesianProduct"),
    }


def skeleton(plan: str) -> str:
    keep = ("Exchange", "Join", "Aggregate", "Union", "Scan", "QueryStage", "Sort ")
    out = []
    for line in plan.splitlines():
        if any(k in line for k in keep):
            line = re.sub(r"#\d+L?", "", line)
            line = re.sub(r", \[plan_id=\d+\]", "", line)
            out.append(line[:150])
    return "\n".join(out)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    import __spark_entry__ as entry
    from twinrun.session import get_session
    spark = get_session()
    qs = entry.queries()
    if argv[2:]:
        qs = {n: qs[n] for n in argv[2:]}
    rows, details = [], {}
    for mode in ("local", "large"):
        big = mode == "large"
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1" if big else "10m")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1" if big else "10m")
        for name, q in qs.items():
            plan = final_plan(q(spark, sf_dir))
            rows.append((name, mode, counts(plan)))
            if name in DETAIL and big:
                details[name] = skeleton(plan)
    cols = list(rows[0][2])
    if argv[2:]:
        for name, mode, c in sorted(rows, key=lambda r: (list(qs).index(r[0]), r[1])):
            print(f"| {name} | {mode} | " + " | ".join(str(c[k]) for k in cols) + " |")
        return
    print("# PLANS\n")
    print(f"Final adaptive plans of every registered query at `{sf_dir}` on local[8],")
    print("generated by `python tests/plan_report.py`.  *local*: as planned here, small")
    print("sides broadcast after a size check; *large*: broadcasts disabled, the shape")
    print("at 100 TB where no join side fits in memory.  `shuffles` counts hash")
    print("exchanges executed (reused ones are listed apart and cost nothing).\n")
    print("| query | plan | " + " | ".join(cols) + " |")
    print("| --- | --- | " + " | ".join("---" for _ in cols) + " |")
    for name, mode, c in sorted(rows, key=lambda r: (list(qs).index(r[0]), r[1])):
        print(f"| {name} | {mode} | " + " | ".join(str(c[k]) for k in cols) + " |")
    for name, sk in details.items():
        print(f"\n## {name} (large)\n\n```\n{sk}\n```")


if __name__ == "__main__":
    main(sys.argv)
