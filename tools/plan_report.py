"""Write PLANS.md: the physical plan facts of every catalog query.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md

For each query: the exchanges (shuffles) by kind, the join strategies, whether
top-n windows are limited before the shuffle, and what reaches the Parquet
scans (pushed filters, read schema).  Plans are taken after execution, so they
are AQE's final plans.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from rideflow.plans import catalog  # noqa: E402
from rideflow.session import build_session  # noqa: E402

# Queries that write files or train models are planned but not listed here.
SKIP = {"rf_metrics", "gbt_metrics", "importances", "saved_model_scores", "reloaded_scores", "model_metrics",
        "importance_sum", "job_run", "random_split_counts"}


def _indent(line: str) -> int:
    return len(line) - len(line.lstrip(" :+-|"))


def _final_only(tree: str) -> str:
    """Drop every "== Initial Plan ==" section (AQE prints one per adaptive plan, subqueries too)."""
    kept, skip_at = [], None
    for line in tree.splitlines():
        if skip_at is not None:
            if _indent(line) >= skip_at:
                continue
            skip_at = None
        if "== Initial Plan ==" in line:
            skip_at = _indent(line)
            continue
        kept.append(line)
    return "\n".join(kept)


def facts(df) -> list[str]:
    df.collect()  # run this DataFrame's own plan, so AQE's final plan is what we read
    final = _final_only(df._jdf.queryExecution().executedPlan().toString())
    own = "\n".join(line for line in final.splitlines() if "ReusedExchange" not in line)
    exchanges = Counter(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition)", own))
    exchanges.update({"broadcast": final.count("BroadcastExchange")} if "BroadcastExchange" in final else {})
    joins = Counter(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)", final))
    pushed = sorted({p for p in re.findall(r"PushedFilters: (\[[^\]]*\])", final) if p != "[]"})
    schemas = sorted({m.rstrip(",") for m in re.findall(r"ReadSchema: (\S+)", final)})
    out = [f"- exchanges: {dict(exchanges) or 'none'}"]
    if joins:
        out.append(f"- joins: {dict(joins)}")
    if "ReusedExchange" in final:
        out.append(f"- reused exchanges: {final.count('ReusedExchange')}")
    if "MapInArrow" in final:
        out.append("- Python: MapInArrow")
    if "ArrowEvalPython" in final:
        out.append("- Python: ArrowEvalPython (pandas UDF)")
    if "BatchEvalPython" in final:
        out.append("- Python: BatchEvalPython (row-at-a-time UDF)")
    if re.search(r"WindowGroupLimit [^\n]*Partial", final):
        out.append("- top-n limited before the shuffle (partial WindowGroupLimit)")
    for p in pushed:
        out.append(f"- pushed: `{p}`")
    for s in schemas:
        out.append(f"- read: `{s}`")
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8, conf={"spark.sql.maxMetadataStringLength": "2000"})
    spark.sparkContext.setLogLevel("ERROR")
    print(f"# Physical plans of the catalog queries\n\nGenerated by `tools/plan_report.py {sf_dir}` "
          "(AQE final plans, local[8], 8 shuffle partitions).\n")
    for name, fn in catalog.queries().items():
        if name in SKIP:
            continue
        print(f"## {name}\n")
        print("\n".join(facts(fn(spark, sf_dir))))
        print()


if __name__ == "__main__":
    main()
