"""Summarise the executed (post-AQE) physical plans of the headline queries as Markdown.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, ".")

from alertlens.plans import queries as Q  # noqa: E402
from alertlens.session import get_spark  # noqa: E402

HEADLINE = ["scan_decisions", "dedup_first", "stratified_sample", "effective_preference", "final", "final_week",
            "latency_counts", "scorecard", "freq_oneway", "freq_crosstab7", "history_replace", "preference_fanout_size"]


def bracketed(plan: str, key: str) -> list[str]:
    """Contents of every ``key: [...]`` with nested brackets."""
    out = []
    for part in plan.split(f"{key}: [")[1:]:
        depth, buf = 1, []
        for ch in part:
            depth += ch == "["
            depth -= ch == "]"
            if depth == 0:
                break
            buf.append(ch)
        out.append("".join(buf))
    return out


def final_plan(plan: str) -> str:
    """AQE prints the final plan and then the initial one; keep the final plan."""
    return plan.split("== Initial Plan ==")[0]


def summarise(plan: str) -> dict:
    def n(pat):
        return len(re.findall(pat, plan))
    return {
        "shuffle exchanges": n(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition|Exchange RoundRobin"),
        "single-partition exchanges": n(r"Exchange SinglePartition"),
        "broadcast exchanges": n(r"BroadcastExchange"),
        "reused exchanges": n(r"ReusedExchange"),
        "WindowGroupLimit (partial, before shuffle)": n(r"WindowGroupLimit .*Partial"),
        "SortMergeJoin": n(r"SortMergeJoin"),
        "BroadcastHashJoin": n(r"BroadcastHashJoin"),
        "ShuffledHashJoin": n(r"ShuffledHashJoin"),
        "nested-loop / cartesian": n(r"BroadcastNestedLoopJoin|CartesianProduct"),
        "partial aggregates": n(r"partial_"),
        "Python UDF nodes": n(r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas"),
        "Expand (grouping sets)": n(r"Expand \["),
    }


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_spark()
    spark.conf.set("spark.sql.maxMetadataStringLength", "400")
    print("# PLANS\n")
    print(f"Executed (post-AQE) physical plans of the headline queries at `{sf}`, `local[8]`, "
          "8 shuffle partitions, generated by `tools/plan_report.py`. Counts are plan nodes of the final plan; "
          "queries that materialize an intermediate (the as-of input, the final table for multi-consumer "
          "queries) show the plan *after* that write.\n")
    for name in HEADLINE:
        df = Q.QUERIES[name](spark, sf)
        df.collect()
        plan = final_plan(df._jdf.queryExecution().executedPlan().toString())
        s = summarise(plan)
        print(f"## `{name}`\n")
        print("| node | count |\n| --- | --- |")
        for k, v in s.items():
            print(f"| {k} | {v} |")
        pushed = sorted(set(bracketed(plan, "PushedFilters")))
        if pushed:
            print("\nPushed filters:\n")
            for p in pushed:
                print(f"* `{p[:300]}`")
        parts = sorted(set(bracketed(plan, "PartitionFilters")))
        parts = [p for p in parts if p]
        if parts:
            print("\nPartition filters:\n")
            for p in parts:
                print(f"* `{p[:300]}`")
        print()


if __name__ == "__main__":
    main()
