"""Card portfolio analytics on Spark.

Typed account / monthly-statement DataFrames, declarative data-quality rules,
behavioural features, rule-based risk tiers, roll-rate (delinquency migration)
matrices, cost-based threshold evaluation and Spark ML default models.

Common entry points::

    from cardpanel import build_session, PortfolioPlan, credit_features, assign_tiers, roll_rates
    plan = PortfolioPlan(spark, "/path/to/tables")       # ingest -> features -> tiers -> view
    overview = portfolio_overview(plan.view)

Full build (processed tables + dashboard extracts)::

    python -m cardpanel.plans.exports --data /path/to/tables --out /shared/output [--with-model]
"""

from cardpanel.session import build_session, checkpoint_dir, cut_lineage, store_table

_LAZY = {
    "PortfolioPlan": "cardpanel.plans.portfolio",
    "export_all": "cardpanel.plans.exports",
    "credit_features": "cardpanel.operators.features",
    "feature_correlations": "cardpanel.operators.features",
    "assign_tiers": "cardpanel.operators.tiers",
    "portfolio_overview": "cardpanel.operators.tiers",
    "account_view": "cardpanel.operators.tiers",
    "roll_rates": "cardpanel.operators.roll",
    "forward_roll": "cardpanel.operators.roll",
    "to_panel": "cardpanel.operators.panel",
    "to_wide": "cardpanel.operators.panel",
    "split_accounts": "cardpanel.operators.panel",
    "check": "cardpanel.operators.quality",
    "enforce": "cardpanel.operators.quality",
    "cost_curve": "cardpanel.operators.evaluation",
    "average_precision": "cardpanel.operators.evaluation",
    "confusion": "cardpanel.operators.evaluation",
    "train_gbt": "cardpanel.operators.modeling",
    "train_logistic": "cardpanel.operators.modeling",
    "score_portfolio": "cardpanel.operators.modeling",
    "tree_attributions": "cardpanel.operators.treeshap",
    "smote": "cardpanel.operators.neighbors",
    "read_accounts": "cardpanel.sources.files",
    "write_table": "cardpanel.sources.files",
    "upsert": "cardpanel.sources.upsert",
}


def __getattr__(name):
    if name in _LAZY:
        import importlib
        return getattr(importlib.import_module(_LAZY[name]), name)
    raise AttributeError(name)


__all__ = ["build_session", "checkpoint_dir", "cut_lineage", "store_table", *_LAZY]
