"""Summarise the physical plan of every registered query: shuffles, join
strategies, partial window limits, pushed filters, Python evaluation.

Operators that number rows (``assign_ids``) run their range exchange while
the query is built; the plan shown is what remains after that write.
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, ".")
from wingspan.plans.queries import QUERIES  # noqa: E402
from wingspan.session import local_session  # noqa: E402

MARKS = {
    "shuffle": r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition|Exchange RoundRobin",
    "single_partition": r"Exchange SinglePartition",
    "broadcast": r"BroadcastExchange",
    "smj": r"SortMergeJoin",
    "bhj": r"BroadcastHashJoin",
    "bnlj": r"BroadcastNestedLoopJoin|CartesianProduct",
    "partial_window_limit": r"WindowGroupLimit.*Partial",
    "partial_agg": r"HashAggregate\(keys=.*functions=\[partial_|SortAggregate\(key=.*partial_",
    "pushed_filters": r"PushedFilters: \[[^\]]",
    "python": r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas",
}


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    print("| query | " + " | ".join(MARKS) + " |")
    print("| --- |" + " --- |" * len(MARKS))
    for name, fn in QUERIES.items():
        df = fn(spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        counts = [len(re.findall(rx, plan)) for rx in MARKS.values()]
        print(f"| {name} | " + " | ".join(str(c) for c in counts) + " |", flush=True)


if __name__ == "__main__":
    main()
