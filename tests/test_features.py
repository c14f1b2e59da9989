from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cardpanel.functions.columns import delinquency_bucket, left_closed_bucket, right_closed_bin
from cardpanel.operators import features as feat
from cardpanel.operators import tiers as tr
from cardpanel.schema import FEATURES
from tests.conftest import customer_rows, dense, panel_rows


def _features(spark, rows):
    from cardpanel.schema import FEATURES_SCHEMA
    conv = []
    for r in rows:
        conv.append(tuple(float(r[f.name]) if f.dataType.typeName() == "double" else int(r[f.name])
                          for f in FEATURES_SCHEMA.fields))
    return spark.createDataFrame(conv, FEATURES_SCHEMA)


def _by_id(df):
    return {r["customer_id"]: r.asDict() for r in df.collect()}


def test_streak_patterns_and_cross_check(spark):
    pats = {1: [1, 1, 1, 0, 0, 0], 2: [1, 0, 1, 1, 0, 1], 3: [0] * 6, 4: [1] * 6, 5: [0, 2, 3, 0, 4, 5]}
    rows = []
    for cid, st in pats.items():
        rows += dense(cid, [100] * 6, [10] * 6, st)
    panel = panel_rows(spark, rows)
    cust = customer_rows(spark, [(c, 1000) for c in pats])
    f = _by_id(feat.credit_features(panel, cust))
    assert {c: f[c]["consecutive_delays"] for c in pats} == {1: 3, 2: 2, 3: 0, 4: 6, 5: 2}
    isl = {r["customer_id"]: r["consecutive_delays"] for r in feat.longest_streak(panel).collect()}
    assert all(isl.get(c, 0) == f[c]["consecutive_delays"] for c in pats)


def test_streak_breaks_on_missing_month_and_null(spark):
    rows = [(1, 1, 10, 0, 1), (1, 2, 10, 0, 1), (1, 4, 10, 0, 1), (1, 5, 10, 0, 1),  # month 3 missing
            (2, 1, 10, 0, 1), (2, 2, 10, 0, None), (2, 3, 10, 0, 1), (2, 4, 10, 0, 1), (2, 5, 10, 0, 1)]
    panel = panel_rows(spark, rows)
    cust = customer_rows(spark, [(1, 100), (2, 100)])
    f = _by_id(feat.credit_features(panel, cust))
    assert f[1]["consecutive_delays"] == 2
    assert f[2]["consecutive_delays"] == 3
    isl = {r["customer_id"]: r["consecutive_delays"] for r in feat.longest_streak(panel).collect()}
    assert isl == {1: 2, 2: 3}


def test_payment_ratio_panel_vs_wide(spark):
    bills = [0, -10, 100, 200, 0, 50]
    pays = [5, 5, 50, 100, 5, 25]
    panel = panel_rows(spark, dense(1, bills, pays, [0] * 6))
    cust = customer_rows(spark, [(1, 1000)])
    p = _by_id(feat.credit_features(panel, cust, "panel"))[1]
    w = _by_id(feat.credit_features(panel, cust, "wide"))[1]
    assert p["payment_ratio"] == pytest.approx(0.5)          # three positive-bill months averaged
    assert w["payment_ratio"] == pytest.approx(1.5 / 6)       # zeros counted, divided by 6


def test_zero_limit_gives_zero_utilization_and_low_tier(spark):
    panel = panel_rows(spark, dense(1, [100] * 6, [100] * 6, [-1] * 6))
    cust = customer_rows(spark, [(1, 0)])
    for sem in ("panel", "wide"):
        f = feat.credit_features(panel, cust, sem)
        row = f.first()
        assert row["avg_utilization"] == 0.0 and row["utilization_trend"] == 0.0
        assert tr.assign_tiers(f).first()["risk_tier"] == "Low Risk"


def test_single_month_slope_and_volatility_zero(spark):
    panel = panel_rows(spark, [(1, 1, 500, 10, 0)])
    cust = customer_rows(spark, [(1, 1000)])
    r = feat.credit_features(panel, cust).first()
    assert r["utilization_trend"] == 0.0 and r["balance_volatility"] == 0.0
    assert r["avg_utilization"] == 0.5


def test_account_without_statements_gets_zero_row(spark):
    panel = panel_rows(spark, dense(1, [100] * 6, [0] * 6, [0] * 6))
    cust = customer_rows(spark, [(1, 1000), (2, 1000)])
    for sem in ("panel", "wide"):
        f = _by_id(feat.credit_features(panel, cust, sem))
        assert all(f[2][c] == 0 for c in FEATURES)


def test_trend_equals_least_squares(spark):
    import numpy as np
    bills = [100, 250, 80, 400, 390, 10]
    panel = panel_rows(spark, dense(1, bills, [0] * 6, [0] * 6))
    cust = customer_rows(spark, [(1, 1000)])
    slope = np.polyfit(np.arange(1, 7), np.array(bills) / 1000, 1)[0]
    assert feat.credit_features(panel, cust, "wide").first()["utilization_trend"] == pytest.approx(slope)
    assert feat.credit_features(panel, cust, "panel").first()["utilization_trend"] == pytest.approx(round(slope, 4))


def test_rounded_vs_unrounded_tier_boundaries(spark):
    base = {c: 0 for c in FEATURES}
    rows = []
    for i, u in enumerate([1.00004, 1.00005, 1.0, 0.39996, 0.4, 0.39994]):
        d = dict(base, customer_id=i, avg_utilization=u, on_time_months=6)
        rows.append(d)
    df = _features(spark, rows)
    unrounded = {r["customer_id"]: r["risk_tier"] for r in tr.assign_tiers(df).collect()}
    rounded = {r["customer_id"]: r["risk_tier"] for r in
               tr.assign_tiers(df.withColumn("avg_utilization", F.round("avg_utilization", 4))).collect()}
    assert unrounded[0] == "High Risk" and rounded[0] == "Medium Risk"
    assert unrounded[1] == "High Risk" and rounded[1] == "High Risk"
    assert unrounded[2] == "Medium Risk"
    assert unrounded[3] == "Low Risk" and rounded[3] == "Medium Risk"
    assert unrounded[4] == "Medium Risk" and unrounded[5] == "Low Risk" and rounded[5] == "Low Risk"


def test_tier_reason_first_match(spark):
    base = {c: 0 for c in FEATURES}
    rows = [dict(base, customer_id=1, avg_utilization=1.5, max_delinquency=4),
            dict(base, customer_id=2, max_delinquency=3, consecutive_delays=4),
            dict(base, customer_id=3, consecutive_delays=3, max_delinquency=1),
            dict(base, customer_id=4, avg_utilization=0.1, on_time_months=6),
            dict(base, customer_id=5, avg_utilization=0.5, on_time_months=6)]
    df = _features(spark, rows)
    got = {r["customer_id"]: (r["risk_tier"], r["tier_reason"]) for r in tr.assign_tiers(df).collect()}
    assert got[1] == ("High Risk", "Average utilization above 100%")
    assert got[2] == ("High Risk", "At least 90-DPD observed")
    assert got[3] == ("High Risk", "Three or more consecutive delayed months")
    assert got[4] == ("Low Risk", "Low utilization with strong on-time history")
    assert got[5] == ("Medium Risk", "Intermediate behavioral risk")


def test_buckets_sql_and_fallthrough(spark):
    df = spark.createDataFrame([(s,) for s in [-2, 0, 1, 2, 3, 4, 9, None]], "s int")
    got = [r[0] for r in df.select(delinquency_bucket("s")).collect()]
    assert got == ["Current", "Current", "30-DPD", "60-DPD", "90-DPD", "90+-DPD", "90+-DPD", None]
    worst = [r[0] for r in df.select(delinquency_bucket("s", null_as_worst=True)).collect()]
    assert worst[-1] == "90+-DPD"


def test_right_closed_and_width_buckets(spark):
    from cardpanel.operators.evaluation import score_bins
    df = spark.createDataFrame([(v,) for v in [0.0, 0.1, 0.1000001, 0.3, 1.0]], "v double")
    assert [r[0] for r in df.select(right_closed_bin("v", score_bins())).collect()] == [1, 1, 2, 3, 10]
    wb = spark.createDataFrame([(v,) for v in [-0.1, 0.0, 0.0999, 0.1, 1.0, 1.5]], "v double")
    assert [r[0] for r in wb.select(left_closed_bucket("v", 0, 1, 10)).collect()] == [0, 1, 1, 2, 11, 11]


def test_constant_column_correlation_is_null(spark):
    rows = [dict({c: float(i) for c in FEATURES}, customer_id=i, on_time_months=6) for i in range(5)]
    df = _features(spark, rows)
    corr = {(r["feature_a"], r["feature_b"]): r["correlation"] for r in feat.feature_correlations(df).collect()}
    assert corr[("avg_utilization", "on_time_months")] is None
    assert corr[("avg_utilization", "balance_volatility")] == 1.0
    long = {(r["feature_a"], r["feature_b"]): r["correlation"] for r in feat.feature_correlations_long(df).collect()}
    assert long == corr


def test_label_distribution_faithful_and_intended(spark):
    df = spark.createDataFrame([(i, y) for i, y in enumerate([0, 0, 0, 1])], "customer_id long, default_next_month int")
    faithful = {r[0]: r[2] for r in tr.label_distribution(df, "group_keys").collect()}
    intended = {r[0]: r[2] for r in tr.label_distribution(df, "rows").collect()}
    assert faithful == {0: 50.0, 1: 50.0}
    assert intended == {0: 25.0, 1: 25.0}


def test_null_month_panel_vs_wide(spark):
    rows = [(1, m, None if m == 3 else 500, 0, 0) for m in range(1, 7)]
    panel = panel_rows(spark, rows)
    cust = customer_rows(spark, [(1, 1000)])
    p = feat.credit_features(panel, cust, "panel").first()
    w = feat.credit_features(panel, cust, "wide").first()
    assert p["avg_utilization"] == 0.5                  # five known months averaged
    assert w["avg_utilization"] == pytest.approx(2.5 / 6)  # the NULL month counts as 0 over six


def test_overview_currency(spark):
    from tests.conftest import SF001
    from cardpanel.plans.portfolio import PortfolioPlan
    p = PortfolioPlan(spark, SF001, materialize=False)
    usd = {r["tier_name"]: r for r in tr.portfolio_overview(p.view, "USD", digits=False).collect()}
    twd = {r["tier_name"]: r for r in tr.portfolio_overview(p.view, "TWD", digits=False).collect()}
    for t in usd:
        assert usd[t]["avg_credit_limit"] * 31 == pytest.approx(twd[t]["avg_credit_limit"])
        assert usd[t]["total_exposure_usd"] == pytest.approx(twd[t]["total_exposure_usd"])
