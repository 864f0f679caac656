"""Summarise the final (adaptive) physical plan of every registered query.

python tools/plan_summary.py [sf_dir] [out_file]

Each query runs once; its own query execution is then final, and the plan is
counted by node kind: shuffles, broadcasts, joins by strategy, windows, scans,
and nodes that would leave the JVM (Python UDFs) or pair every row
(Cartesian products). Eager jobs of a query (class counts, lineage cuts) are
not in its final plan; the final plan reads the tables they wrote.
"""

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from readyspark.plans.queries import QUERIES  # noqa: E402
from readyspark.session import build_session  # noqa: E402

KINDS = {
    "shuffle": r"^\s*[:+\- ]*Exchange (hash|range|round|Single)",
    "reused": r"ReusedExchange",
    "broadcast": r"BroadcastExchange",
    "smj": r"SortMergeJoin",
    "bhj": r"BroadcastHashJoin",
    "shj": r"ShuffledHashJoin",
    "bnlj": r"BroadcastNestedLoopJoin",
    "cartesian": r"CartesianProduct",
    "window": r"(?<![A-Za-z])Window \[",
    "scan": r"FileScan parquet",
    "python": r"(BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas|PythonUDF)",
}


def summarise(plan: str) -> dict:
    final = plan.split("== Initial Plan ==")[0]  # an adaptive plan prints both
    return {k: len(re.findall(p, final, flags=re.M)) for k, p in KINDS.items()}


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    out_file = sys.argv[2] if len(sys.argv) > 2 else "PLANS.md"
    spark = build_session("local[8]", shuffle_partitions=8)
    rows = []
    for name, fn in QUERIES.items():
        spark.sparkContext.setJobGroup(name, name)
        df = fn(spark, sf)
        eager = len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
        qe = df._jdf.queryExecution()
        qe.toRdd().count()  # runs this query execution, so its adaptive plan is final
        rows.append((name, {"eager jobs": eager, **summarise(qe.executedPlan().toString())}))
    spark.stop()
    kinds = ["eager jobs", *KINDS]
    head = ["query"] + kinds
    lines = ["# Final physical plans", "",
             f"Generated by `tools/plan_summary.py` at `{sf}` (local[8], 8 shuffle partitions).",
             "Counts are nodes of each query's final adaptive plan: `shuffle` = shuffle exchanges",
             "(reused ones counted apart), `broadcast` = broadcast exchanges, join columns by",
             "strategy (`bnlj` = broadcast nested loop), `python` = nodes that run Python.",
             "`eager jobs` = Spark jobs run while the query is built (class counts, size checks, written",
             "tables, model fits; with adaptive execution a job per shuffle); they are not in the final plan.", "",
             "| " + " | ".join(head) + " |", "| " + " | ".join("---" for _ in head) + " |"]
    for name, c in rows:
        lines.append("| " + " | ".join([name] + [str(c[k]) for k in kinds]) + " |")
    totals = {k: sum(c[k] for _, c in rows) for k in kinds}
    lines.append("| **total** | " + " | ".join(str(totals[k]) for k in kinds) + " |")
    with open(out_file, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    print(out_file, totals)


if __name__ == "__main__":
    main()
