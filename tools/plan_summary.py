"""Plan shape of every registered query: operators of its executed plan.

Usage: python tools/plan_summary.py [sf_dir] > PLANS.md

The bill is derived from ``<sf_dir>/lineitem.parquet`` and written as Parquet
first (as an export is), then each query runs once over it (``collect``, so
its own plan is the one executed).
"""

from __future__ import annotations

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from billmodel import CostModel, read_cur  # noqa: E402
from billmodel.plans.registry import edge, model_queries  # noqa: E402
from billmodel.session import local_session  # noqa: E402
from billmodel.sources.fixture import lineitem_bill  # noqa: E402

KINDS = {
    "FileSourceScanExec": "parquet scans",
    "ShuffleExchangeExec": "shuffles",
    "BroadcastExchangeExec": "broadcasts",
    "ReusedExchangeExec": "reused",
    "ReusedSubqueryExec": "reused",
    "BroadcastHashJoinExec": "broadcast hash joins",
    "SortMergeJoinExec": "sort-merge joins",
    "ShuffledHashJoinExec": "shuffled hash joins",
    "BroadcastNestedLoopJoinExec": "nested-loop / cartesian",
    "CartesianProductExec": "nested-loop / cartesian",
}
COLUMNS = list(dict.fromkeys(KINDS.values()))


def _seq(s) -> list:
    return [s.apply(i) for i in range(s.size())]


def count_operators(node, counts: dict) -> None:
    """Walk the executed plan: final adaptive plans, query stages and
    subqueries; a reused exchange counts as reuse and is not walked again."""
    kind = node.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return count_operators(node.executedPlan(), counts)
    if kind.endswith("QueryStageExec"):
        return count_operators(node.plan(), counts)
    if kind in KINDS:
        counts[KINDS[kind]] += 1
    if kind.startswith("Reused"):
        return
    for sub in _seq(node.subqueries()):
        count_operators(sub, counts)
    for child in _seq(node.children()):
        count_operators(child, counts)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    path = tempfile.mkdtemp(prefix="plans-") + "/cur"
    lineitem_bill(spark, sf_dir).write.parquet(path)
    bill = read_cur(spark, path)
    print(f"# Plan shapes\n\nOperators of the executed plans of the registered queries over the bill derived "
          f"from `{os.path.basename(sf_dir.rstrip('/'))}` and read from Parquet (`tools/plan_summary.py`). "
          "Counted after the query ran, in the final adaptive plans including scalar subqueries; an "
          "exchange reused at run time counts under `reused` only. Scans include the small filtered "
          "scans that feed leftovers and dimensions; shuffles carry partial aggregates or small sides.\n")
    print("| query | " + " | ".join(COLUMNS) + " |")
    print("| --- |" + " --- |" * len(COLUMNS))
    for name, fn in model_queries().items():
        df = edge(fn(CostModel(bill)))
        df.collect()  # runs this DataFrame's own plan, so the final plan is the executed one
        counts = dict.fromkeys(COLUMNS, 0)
        count_operators(df._jdf.queryExecution().executedPlan(), counts)
        print(f"| `{name}` | " + " | ".join(str(counts[c]) for c in COLUMNS) + " |")


if __name__ == "__main__":
    main()
