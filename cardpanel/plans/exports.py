"""Full build: processed tables (Parquet) and dashboard extracts (CSV).

``export_all`` writes what the batch build publishes - the model tables, roll
rates, tier summary, score distribution, cost curve, top accounts, metrics
record - plus the dashboard's extracts.  Large tables are written in parallel
as Parquet; only bounded extracts (3 tiers, <= 125 roll cells, 10 bins,
500 accounts, 8 features) are coalesced into one CSV file each.
"""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from cardpanel.operators import evaluation as ev
from cardpanel.operators import reporting as rp
from cardpanel.operators import roll as rl
from cardpanel.operators import tiers as tr
from cardpanel.plans.portfolio import PortfolioPlan
from cardpanel.sources.files import copy_if_exists, with_load_ts, write_metrics, write_table

# Dashboard files that another job may have left in the source folder.
OPTIONAL_SOURCES = ["risk_score_distribution.csv", "top_risk_accounts.csv", "feature_importance.csv"]


def export_all(plan: PortfolioPlan, out_dir: str, with_model: bool = False, extra_source: str | None = None) -> dict[str, str]:
    """Write every output table; returns name -> path.

    Without a model the scores are the heuristic probability.  Cost curve, savings
    and precision come from the test split only.  ``extra_source`` names a folder of
    further dashboard files, copied where they exist."""
    spark = plan.spark
    processed, dash = os.path.join(out_dir, "processed"), os.path.join(out_dir, "dashboard")
    roll, view = rl.roll_rates(plan.panel), plan.view
    scores, test = plan.scores, plan.test_scores
    if with_model:
        from cardpanel.operators import modeling as md
        from cardpanel.plans import queries_model as qm
        d, t = qm.model_of(plan)
        scored = md.score_portfolio(t, d.select("customer_id", "default_next_month", "split", *md.FEATURES))
        scores = scored.select("customer_id", "default_next_month", "risk_score")
        test = scored.filter("split = 'test'").select("customer_id", "default_next_month", "risk_score")
    curve = ev.cost_curve(test)
    # the local line summarises tiers of unrounded features
    local = plan.with_semantics("wide")
    overview_local = tr.portfolio_overview(local.view, currency="TWD", digits=False)
    top = rp.top_risk_accounts(view, scores, 500)
    written = {}
    big = {
        "customers": with_load_ts(plan.customers), "monthly_payments": plan.panel, "outcomes": plan.outcomes,
        "credit_features": plan.features, "risk_tiers": with_load_ts(plan.tiers, "assigned_at"),
        "risk_scores": view.join(scores.select("customer_id", "risk_score"), "customer_id")
        .withColumn("fraud_risk_score", F.col("risk_score")),
    }
    if plan.rejected is not None:
        big["rejected_records"] = plan.rejected
    for name, df in big.items():
        written[name] = write_table(df, os.path.join(processed, name))
    small = {
        "roll_rate_matrix": roll, "forward_roll_summary": rl.forward_roll(plan.panel, plan.outcomes),
        "tier_summary": overview_local.select(
            F.col("tier_name").alias("risk_tier"), "account_count", "default_rate_pct", "avg_credit_limit",
            "total_exposure_usd", "avg_utilization", "avg_on_time_months", "pct_of_portfolio"),
        "risk_score_distribution": ev.score_distribution(scores), "threshold_cost_curve": curve,
        "top_risk_accounts": top,
    }
    for name, df in small.items():
        written[name] = write_table(df, os.path.join(processed, name), small=True)
    extracts = {
        "portfolio_overview": tr.portfolio_overview(view, currency="USD", digits=True),
        "portfolio_overview_local": overview_local,
        "roll_rate_matrix": roll.select("from_bucket", "to_bucket", "pct_of_accounts", "month_pair"),
        "risk_score_distribution": ev.score_distribution(scores),
        "top_risk_accounts": top,
    }
    if with_model:
        from cardpanel.operators.explain import attribution_importance
        from cardpanel.operators.treeshap import tree_attributions
        explained = tree_attributions(d.filter("split = 'test'"), t.model)
        importance = attribution_importance(explained).withColumnRenamed("mean_abs_value", "mean_abs_shap_value")
        written["feature_importance"] = write_table(importance, os.path.join(processed, "feature_importance"), small=True)
        extracts["feature_importance"] = importance
        written["top_20_shap_drivers"] = write_table(qm.tree_top_drivers(plan), os.path.join(processed, "top_20_shap_drivers"), small=True)
    for name, df in extracts.items():
        written[f"dashboard/{name}"] = write_table(df, os.path.join(dash, name), fmt="csv", small=True)
    for name in OPTIONAL_SOURCES if extra_source else ():
        if f"dashboard/{name.removesuffix('.csv')}" in written:
            continue  # made here
        if copy_if_exists(spark, os.path.join(extra_source, name), os.path.join(dash, name)).first()["status"] == "copied":
            written[f"dashboard/{name}"] = os.path.join(dash, name)
    kpis = tr.portfolio_kpis(view).select("accounts", "overall_default_rate", "total_exposure_usd")
    if with_model:
        record = qm.model_metrics(plan).drop("accounts", "overall_default_rate")
    else:
        best = ev.optimal_threshold(curve).select("threshold").first()[0]
        f2 = ev.fbeta(ev.confusion(test, float(best)), 2.0).select("fbeta")
        record = ev.threshold_summary(curve).withColumns({"average_precision": ev.average_precision(test).scalar(), "f2_at_optimum": f2.scalar()})
    metrics = kpis.withColumns({c: record.select(c).scalar() for c in record.columns})
    written["metrics"] = write_metrics(metrics, os.path.join(processed, "metrics"))
    return written


def main(argv=None) -> None:
    import argparse
    import json

    from cardpanel.session import build_session

    ap = argparse.ArgumentParser(description="Build every processed table and dashboard extract.")
    source = ap.add_mutually_exclusive_group(required=True)
    source.add_argument("--accounts", help="card file: CSV with a header, 25 columns bound by position")
    source.add_argument("--data", help="folder with customer/orders/lineitem parquet tables (test adapter)")
    ap.add_argument("--extra", default=None, help="folder of further dashboard files to copy where they exist")
    ap.add_argument("--out", required=True, help="output folder (shared storage on a cluster)")
    ap.add_argument("--with-model", action="store_true", help="train the boosted model and export its outputs")
    ap.add_argument("--master", default=None, help="Spark master (default: from spark-submit, else local[*])")
    a = ap.parse_args(argv)
    from pyspark.sql import SparkSession
    spark = (SparkSession.getActiveSession() or
             build_session(a.master or "local[*]", shuffle_partitions=8))
    from cardpanel.session import size_for_input
    paths = [a.accounts] if a.accounts else [f"{a.data}/{t}.parquet" for t in ("customer", "orders", "lineitem")]
    size_for_input(spark, paths)
    plan = PortfolioPlan.from_accounts(spark, a.accounts) if a.accounts else PortfolioPlan(spark, a.data)
    print(json.dumps(export_all(plan, a.out, a.with_model, a.extra), indent=1))


if __name__ == "__main__":
    main()
