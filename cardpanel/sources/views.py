"""Named views over the portfolio tables, for SQL users."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cardpanel.operators.roll import bucketed


def register_views(customers: DataFrame, panel: DataFrame, outcomes: DataFrame,
                   features: DataFrame | None = None, tiers: DataFrame | None = None) -> list[str]:
    """Temp views customers, monthly_payments, outcomes, delinquency_buckets
    (+ credit_features, risk_tiers when given)."""
    views = {"customers": customers, "monthly_payments": panel, "outcomes": outcomes,
             "delinquency_buckets": bucketed(panel)}
    if features is not None:
        views["credit_features"] = features
    if tiers is not None:
        views["risk_tiers"] = tiers
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
