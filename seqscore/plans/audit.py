"""Physical-plan audit of every registered query.

``python -m seqscore.plans.audit [sf_dir] > PLANS.md`` builds each query,
reads its executed plan (the AQE initial plan; pinned inputs appear as
``ExistingRDD`` scans) and summarises what matters at scale: shuffles by
kind, join strategies, windows, Python evaluation nodes, and for every
Parquet scan the columns read and the filters pushed into it.
"""

from __future__ import annotations

import re
import sys
from collections import Counter


def summarise(plan: str) -> dict:
    ex = Counter()
    for m in re.finditer(r"Exchange (\w+)", plan):
        ex[m.group(1).lower()] += 1
    joins = Counter(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|"
                               r"BroadcastNestedLoopJoin|CartesianProduct)", plan))
    scans = []
    for line in plan.splitlines():
        if "FileScan parquet" not in line:
            continue
        table = re.search(r"/([\w.]+)\.parquet\]", line)
        schema = re.search(r"ReadSchema: struct<([^>]*)", line)
        pushed = re.search(r"PushedFilters: \[([^\]]*)\]", line)
        cols = [c.split(":")[0] for c in schema.group(1).split(",")] if schema else []
        scans.append({"table": table.group(1) if table else "?", "columns": len(cols),
                      "pushed": pushed.group(1) if pushed and pushed.group(1) else ""})
    return {
        "exchanges": dict(ex), "joins": dict(joins),
        "windows": plan.count("Window ["),
        "python": sum(plan.count(k) for k in ("ArrowEvalPython", "MapInPandas", "BatchEvalPython")),
        "pinned_scans": plan.count("ExistingRDD"),
        "scans": scans,
    }


def main(argv: list[str]) -> int:
    from seqscore.plans.catalog import QUERIES
    from seqscore.session import local_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, 8)
    print("# Plan audit\n")
    print(f"Generated by `python -m seqscore.plans.audit {sf_dir}` (AQE initial plans; "
          "`ExistingRDD` = a pinned, checkpointed input).\n")
    print("| query | exchanges | joins | windows | python | pinned | parquet scans (cols read; pushed filters) |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    for name in sorted(QUERIES):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        ex = ", ".join(f"{k} {v}" for k, v in sorted(s["exchanges"].items())) or "-"
        jn = ", ".join(f"{k} {v}" for k, v in sorted(s["joins"].items())) or "-"
        sc = "; ".join(f"{x['table']} ({x['columns']}{'; ' + x['pushed'] if x['pushed'] else ''})"
                       for x in s["scans"]) or "-"
        print(f"| {name} | {ex} | {jn} | {s['windows']} | {s['python']} | {s['pinned_scans']} | {sc} |")
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
