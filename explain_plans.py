"""Write docs/PLANS.md: a physical-plan inventory of every core query.

Usage: python explain_plans.py [sf_dir]

Per query: shuffle exchanges, broadcast exchanges, join strategies, partial
window limits (top-1 before the shuffle), Expand operators and Python steps,
read from the initial adaptive plan; plus the full formatted plan of the
headline account-grain mart build.
"""

from __future__ import annotations

import re
import sys

from ledgermart.plans import driver_models as M
from ledgermart.plans import driver_sources as S
from ledgermart.plans import driver_tables as D
from ledgermart.session import get_session

PATTERNS = {
    "shuffles": r"Exchange (hashpartitioning|rangepartitioning|RoundRobinPartitioning|SinglePartition)",
    "broadcasts": r"BroadcastExchange",
    "smj": r"SortMergeJoin",
    "bhj": r"BroadcastHashJoin",
    "shj": r"ShuffledHashJoin",
    "partial_limit": r"WindowGroupLimit .*Partial",
    "expand": r"\bExpand\b",
    "python": r"(MapInPandas|ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas)",
    "nested_loop_or_cartesian": r"(BroadcastNestedLoopJoin|CartesianProduct)",
}


def main(argv):
    d = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", shuffle_partitions=16)
    lines = ["# Physical plans", "",
             f"Initial adaptive plans at `{d}` (`local[8]`); counts of operators per registered query.",
             "Broadcasts of orders/part at this scale are AQE decisions under the 32 MiB threshold;",
             "at 100 TB the same joins plan as sort-merge joins.", "",
             "Scalar subqueries are separate plans and are included. `mart_reads` counts scans of the",
             "mart tables (the build plan of the account-grain mart is shown once below). The",
             "training-data queries write intermediate tables while they run; the check tool's report",
             "has their stages.", "",
             "| query | " + " | ".join(PATTERNS) + " | mart_reads |", "|---|" + "---|" * (len(PATTERNS) + 1)]
    for name, fn in {**D.RECIPES, **M.RECIPES, **S.RECIPES}.items():
        plan = fn(spark, d)._jdf.queryExecution().executedPlan().toString()
        counts = [str(len(re.findall(p, plan))) for p in PATTERNS.values()]
        counts.append(str(len(re.findall(r"FileScan parquet .*/marts/", plan))))
        lines.append(f"| {name} | " + " | ".join(counts) + " |")
    lines += ["", "## Account-grain mart build (lineitem ⋈ orders ⋈ part ⋈ customer), formatted", "",
              "The line fact (D17 analogue) and the population queries read this mart.", "", "```"]
    lines.append(D.build_member_account_month(spark, d)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")))
    lines += ["```", ""]
    with open("docs/PLANS.md", "w") as fh:
        fh.write("\n".join(lines))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
