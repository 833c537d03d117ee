"""Physical-plan report of every registered query (final adaptive plan after execution).

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
Counts shuffles, broadcasts, join strategies and aggregate kinds, and checks that no
Cartesian / nested-loop join or Python evaluation appears.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    qe = df._jdf.queryExecution()
    return qe.executedPlan().toString()


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from martlane.session import get_spark
    from martlane.plans.warehouse import DEPENDS
    from martlane.suite import QUERIES, warehouse
    spark = get_spark("local[8]", shuffle_partitions=16)
    print(f"# Physical plans at `{sf_dir}` (final adaptive plans, local[8], 16 shuffle partitions)\n")
    print("Shuffle = hash/range exchanges; Bcast = broadcast exchanges; SMJ/BHJ/SHJ = sort-merge, "
          "broadcast-hash, shuffled-hash joins; Agg = hash / object-hash / sort aggregates. "
          "Pushed = scans with pushed filters. A query that reads a published mart shows only "
          "its own last step; the marts' own builds are the rows `mart: ...`.\n")
    print("| query | Shuffle | Bcast | SMJ | BHJ | SHJ | HashAgg | ObjAgg | SortAgg | scans | Pushed | bad ops |")
    print("|---|---|---|---|---|---|---|---|---|---|---|---|")
    plans = {name: (lambda fn=fn: fn(spark, sf_dir)) for name, fn in QUERIES.items()}
    plans |= {f"mart: {name}": (lambda name=name: warehouse(spark, sf_dir)._build(name)) for name in DEPENDS}
    for name, made in plans.items():
        plan = final_plan(made())
        c = lambda pat: len(re.findall(pat, plan))
        bad = [b for b in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                           "ArrowEvalPython") if b in plan]
        print(f"| {name} | {c(r'Exchange (hash|range|Single|RoundRobin)')} | {c(r'BroadcastExchange')} | "
              f"{c(r'SortMergeJoin')} | {c(r'BroadcastHashJoin')} | {c(r'ShuffledHashJoin')} | "
              f"{c(r'HashAggregate')} | {c(r'ObjectHashAggregate')} | {c(r'SortAggregate')} | "
              f"{c(r'FileScan parquet')} | {c(r'PushedFilters: \[[^\]]')} | {', '.join(bad) or '-'} |")
        sys.stdout.flush()


if __name__ == "__main__":
    main()
