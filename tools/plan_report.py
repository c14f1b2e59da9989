"""Physical-plan summary of every registered query, as a cluster would plan
it: broadcasts of data-sized sides disabled (autoBroadcastJoinThreshold=-1)
and AQE off so the static plan is shown.  Prints a markdown table:
hash exchanges, single-partition exchanges, sort-merge joins, scans with
pushed filters, Python (pandas) nodes.

    python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def summarize(plan: str) -> dict:
    return {
        "hash_exchanges": len(re.findall(r"Exchange hashpartitioning", plan)),
        "range_exchanges": len(re.findall(r"Exchange rangepartitioning", plan)),
        "single_partition": len(re.findall(r"Exchange SinglePartition", plan)),
        "smj": plan.count("SortMergeJoin"),
        "bhj": plan.count("BroadcastHashJoin"),
        "nested_loop": plan.count("BroadcastNestedLoopJoin") + plan.count("CartesianProduct"),
        "scans": plan.count("FileScan parquet"),
        "pushed": len(re.findall(r"PushedFilters: \[[^\]]+\]", plan)),
        "python": plan.count("MapInPandas") + plan.count("FlatMapGroupsInPandas"),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from cardpanel.plans.catalog import REGISTRY
    from cardpanel.session import build_session
    spark = build_session("local[8]", 8)
    skip = {"train_logistic", "logistic_attributions", "train_gbt", "train_gbt_smote", "score_portfolio",
            "model_metrics", "tree_attributions", "tree_top_drivers", "train_gbt_smote_in_folds", "logistic_newton", "logistic_coefficients"}
    print("| query | hash exch | range exch | single-part exch | SMJ | BHJ | nested loop | scans | pushed | pandas |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for name, q in REGISTRY.items():
        if name in skip:
            continue
        df = q.build(spark, sf_dir)  # materialisation (if any) happens with the default settings
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            s = summarize(df._jdf.queryExecution().executedPlan().toString())
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
            spark.conf.set("spark.sql.adaptive.enabled", "true")
        print(f"| {name} | " + " | ".join(str(v) for v in s.values()) + " |", flush=True)


if __name__ == "__main__":
    main()
