"""Summarise the final (post-AQE) physical plans of the headline queries as Markdown.

usage: python tools/plan_summary.py [sf_dir] > PLANS.md
"""
from __future__ import annotations

import re
import sys

sys.path.insert(0, ".")
from bench import HEADLINE  # noqa: E402
from sentinela.plans.catalog import QUERIES  # noqa: E402
from sentinela.session import build_session  # noqa: E402


NOTES = {
    "gold_fraude_estado": "fact -> per-account partials (partial+final aggregate, 1 shuffle of <= one row per "
                          "account per task); accounts/customers joined at account size; state rollup partial+final.",
    "gold_por_hora": "one scan: (hour, account) partials, then one row per hour; accounts are counted as groups.",
    "gold_perfil_risco": "as mart 1, then customer-level groupBy; the single-partition exchange is the median "
                         "scalar subquery (value->count map, <= 1001 entries).",
    "gold_diario": "as mart 2 with days instead of hours.",
    "gold_fraude_estado_multi": "many accounts per customer: same plan, the per-account step collapses line items "
                                "to orders before any join.",
    "gold_perfil_risco_multi": "same plan as mart 3; the count-distinct of accounts runs on account-sized rows.",
    "gold_diario_multi": "as gold_diario, over line items.",
    "insight_top_estados": "mart 1 + TakeOrderedAndProject (top-k per task, k rows merged).",
    "clean_transacoes": "narrow: one codegen stage fused with the scan, no shuffle.",
    "quality_report": "5 one-row aggregates (single-partition exchanges carry one row per task).",
    "audit_fk_orphans": "one scan per child: references unpivoted to (relation, key) and counted before the anti join.",
    "audit_unique": "one scan per table: unique columns unpivoted to (column, value), grouped once.",
    "vw_transacoes_completa": "one fact scan; accounts and merchants left to AQE (broadcast if measured small, skewed "
                              "partitions split); rows without a merchant are salted.",
    "velocity_trailing": "one exchange on (key, sub-bucket) over each event and a bare copy of its time; middle "
                         "sub-bucket counts from a (key, sub-bucket) aggregate enter as rows; no join.",
    "alert_documents": "velocity windows as above; only alerting events are joined to the account state.",
}


def final_plan(df) -> str:
    """The plan that ran: this very query execution is executed, so AQE has finished re-planning it."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.execute().count()
    return plan.toString()


def summarise(plan: str) -> dict:
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", plan)
    return {
        "shuffles": len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition",
                                   plan)),
        "single_partition": len(re.findall(r"Exchange SinglePartition", plan)),
        "broadcasts": len(re.findall(r"BroadcastExchange", plan)),
        "smj": len(re.findall(r"SortMergeJoin", plan)),
        "bhj": len(re.findall(r"BroadcastHashJoin", plan)),
        "windows": len(re.findall(r"\bWindow \[", plan)),
        "python": len(re.findall(r"FlatMapGroupsInPandas|ArrowEvalPython|BatchEvalPython|MapInPandas", plan)),
        "max_cols_read": max((len(s.split(",")) for s in scans), default=0),
        "pushed": sorted({p for p in pushed if p}),
    }


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session()
    print(f"# Physical plans of the headline queries ({sf_dir}, local[8], AQE on)\n")
    print("Generated by `tools/plan_summary.py`. Counts are over the text of the executed plan, which names the final and the initial plan of each adaptive query (so most count double), scalar subqueries "
          "included. `SinglePartition` exchanges only ever carry global aggregates (one row per task).\n")
    print("| query | shuffles | of which single-partition | broadcasts | sort-merge joins | broadcast joins "
          "| window ops | python nodes | widest parquet read (cols) | pushed filters |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    plans = {}
    for name in HEADLINE:
        if name == "stream_alerts":
            continue
        plan = final_plan(QUERIES[name](spark, sf_dir))
        plans[name] = plan
        s = summarise(plan)
        print(f"| `{name}` | {s['shuffles']} | {s['single_partition']} | {s['broadcasts']} | {s['smj']} | "
              f"{s['bhj']} | {s['windows']} | {s['python']} | {s['max_cols_read']} | "
              f"{'; '.join(s['pushed'])[:120]} |")
    print("\n## What each plan shuffles, and how it scales\n")
    for name, note in NOTES.items():
        print(f"* `{name}`: {note}")
    print("\n`stream_alerts` counts each micro-batch with the plan of `velocity_trailing` over the batch and the "
          "retained history.\n")
    print("## Final plan: `gold_fraude_estado`\n\n```")
    print(plans["gold_fraude_estado"])
    print("```\n\n## Final plan: `velocity_trailing`\n\n```")
    print(plans["velocity_trailing"])
    print("```")


if __name__ == "__main__":
    main()
