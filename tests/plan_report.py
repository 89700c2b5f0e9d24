"""Physical-plan summary of every registered query (after execution, final AQE plan).

Usage: python tests/plan_report.py [sf_dir] > PLANS.md
Per query: shuffle exchanges (by kind), broadcast exchanges, and the columns each
parquet scan reads.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def summarize(plan: str) -> dict:
    kinds: dict[str, int] = {}
    for line in plan.splitlines():
        m = re.search(r"Exchange (hashpartitioning|rangepartitioning|RoundRobinPartitioning|SinglePartition)", line)
        if not m or "BroadcastExchange" in line or "ReusedExchange" in line:
            continue
        origin = re.search(r"(ENSURE_REQUIREMENTS|REPARTITION_BY_COL|REPARTITION_BY_NUM)", line)
        k = f"{m.group(1).split('partitioning')[0] or m.group(1)}:{origin.group(1) if origin else 'other'}"
        kinds[k] = kinds.get(k, 0) + 1
    scans = sorted(set(re.findall(r"ReadSchema: (struct<[^>]*>)", plan)))
    return {
        "shuffles": kinds,
        "reused": plan.count("ReusedExchange"),
        "broadcasts": plan.count("BroadcastExchange"),
        "python": len(re.findall(r"MapInPandas|MapInArrow|ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas", plan)),
        "scans": scans,
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from skilltrends.session import build_session
    from __spark_entry__ import queries
    spark = build_session("local[8]", shuffle_partitions=16)
    print("# Physical plans (final AQE plans, executed on", os.path.basename(sf_dir), ")\n")
    print("""`RoundRobinPartitioning` and `hash:REPARTITION_BY_NUM` exchanges are the spread of single-row-group test files
over the cores (`sources.tables.spread`); with file-split inputs at scale they disappear.
`hash:ENSURE_REQUIREMENTS` are the shuffles the operators need (aggregations, joins on big sides).
Broadcasts are fixed configuration tables, samples of a documented size, or the engine's choice for a side
measured small. `python` counts Arrow stages. Fits, stored tables and component rounds run as separate
jobs before the plan shown.
""")
    print("| query | shuffle exchanges | reused | broadcasts | python | parquet columns read |")
    print("|---|---|---|---|---|---|")
    for name, fn in queries().items():
        df = fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        qe = df._jdf.queryExecution()
        plan = qe.executedPlan().toString()
        try:  # the final adaptive plan, when available
            plan = qe.executedPlan().finalPhysicalPlan().toString()
        except Exception:
            pass
        s = summarize(plan)
        sh = ", ".join(f"{k} x{v}" for k, v in sorted(s["shuffles"].items())) or "none"
        cols = "; ".join(x.replace("struct<", "").replace(">", "") for x in s["scans"])
        print(f"| {name} | {sh} | {s['reused']} | {s['broadcasts']} | {s['python']} | {cols} |", flush=True)
    # the flagship query's executed plan, in full
    df = queries()["skills_view"](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    plan = re.sub(r"#\d+L?", "", plan)
    print("\n## Flagship: skills_view (executed plan)\n\n```")
    print("\n".join(line[:200] for line in plan.splitlines()))
    print("```")
    spark.stop()


if __name__ == "__main__":
    main()
