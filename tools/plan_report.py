"""Summarise the physical plan of every registered query.

    python tools/plan_report.py [sf_dir] > PLANS.md

For each query: shuffles (hash exchanges), broadcasts and their sides,
join operators, partial aggregation / window-group-limit before a shuffle,
and the filters pushed into Parquet scans.  Plans are taken after
execution, so they are AQE's final plans at that scale.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarise(plan: str) -> dict:
    final = plan.split("== Initial Plan ==")[0]
    joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|"
                       r"CartesianProduct)\s*\[[^\]]*\],\s*\[[^\]]*\],\s*(\w+)", final)
    pushed = sorted({p for p in re.findall(r"PushedFilters: \[([^\]]+)\]", final)})
    return {
        "shuffles": len(re.findall(r"(?<!\], )Exchange hashpartitioning", final)),
        "single": len(re.findall(r"Exchange SinglePartition", final)),
        "broadcasts": len(re.findall(r"BroadcastExchange", final)),
        "joins": [f"{j}:{t}" for j, t in joins],
        "partial_agg": bool(re.search(r"partial_|Partial", final)),
        "group_limit": "WindowGroupLimit" in final,
        "pushed": pushed,
    }


def main(argv) -> int:
    from boardlake.session import build_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("plan-report", master="local[8]", conf={
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    from boardlake.plans.catalog import QUERIES
    print(f"# Physical plans of the registered queries ({os.path.basename(sf_dir)}, AQE final plans)\n")
    print("Generated by `tools/plan_report.py`.  *shuffles* counts hash exchanges (a reused one once); *single* counts "
          "exchanges to one partition (global aggregates of one row); joins are `operator:type`.\n")
    print("Where the shuffles come from:\n")
    print("* silver (`silver_*`, `unique_cards`, `activity_*`, `idle_*`, `medallion_e2e`): member names "
          "aggregated by card id (partial `collect_set` before the shuffle); card rows joined to those "
          "names by id; in the stand-in only, the board table derived with a `distinct` over orders. "
          "AQE broadcasts members and boards after their exchange has measured them.")
    print("* unique cards and the activity queries: one more shuffle by card name for the newest-per-name "
          "window, with a partial `WindowGroupLimit` before it.")
    print("* `upsert*`: one shuffle per side on the key for the full outer join (the duplicate check "
          "shares it); `upsert_small_batch` is the same here, where no checkpoint folder is set; with one it "
          "shuffles only the batch and streams the target.")
    print("* `idle_*`, `list_lookup*`: in the stand-in, the list table is derived with a `distinct` over "
          "orders, plus the per-board `min_by`.\n")
    print("| query | shuffles | single | broadcasts | joins | partial agg / limit | filters pushed to Parquet |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    for name, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        df._jdf.queryExecution().toRdd().count()      # runs this very plan, so that it is final
        s = summarise(df._jdf.queryExecution().executedPlan().toString())
        part = ", ".join(x for x, on in (("partial agg", s["partial_agg"]), ("group limit", s["group_limit"])) if on)
        pushed = "; ".join(s["pushed"]) if s["pushed"] else ""
        print(f"| `{name}` | {s['shuffles']} | {s['single']} | {s['broadcasts']} | {', '.join(s['joins'])} | "
              f"{part} | {pushed} |")
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
