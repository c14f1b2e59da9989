from __future__ import annotations


from cardpanel.operators import features as feat
from cardpanel.operators import quality as qa
from cardpanel.operators import tiers as tr
from cardpanel.plans.portfolio import PortfolioPlan
from cardpanel.schema import FEATURES, TIER_ORDER
from cardpanel.sources.views import register_views
from tests.conftest import SF001


def test_register_views_sql(spark):
    p = PortfolioPlan(spark, SF001, materialize=False)
    names = register_views(p.customers, p.panel, p.outcomes, p.features, p.tiers)
    assert "delinquency_buckets" in names
    n = spark.sql("SELECT COUNT(*) FROM delinquency_buckets WHERE month_number = 1").first()[0]
    assert n == p.customers.count()


def test_shape_and_types(spark):
    p = PortfolioPlan(spark, SF001, materialize=False)
    meta = qa.shape_and_types(p.customers, "customers").collect()
    assert [r["column_name"] for r in meta][:2] == ["customer_id", "credit_limit"]
    assert {r["rows"] for r in meta} == {150}


def test_clean_features(spark):
    df = spark.createDataFrame([(1, float("inf"), float("nan"), None, -float("inf"), 1.0, 2.0, 3.0, 4.0)],
                               "customer_id long, " + ", ".join(f"{c} double" for c in FEATURES))
    r = feat.clean_features(df).first()
    assert [r[c] for c in FEATURES] == [0.0, 0.0, 0.0, 0.0, 1.0, 2.0, 3.0, 4.0]


def test_correlation_matrix_symmetric(spark):
    p = PortfolioPlan(spark, SF001, materialize=False)
    m = {r["feature_a"]: r.asDict() for r in feat.correlation_matrix(p.features).collect()}
    assert len(m) == 8
    assert all(m[a][a] == 1.0 for a in FEATURES)
    assert m["avg_utilization"]["payment_ratio"] == m["payment_ratio"]["avg_utilization"]


def test_ordered_category_order(spark):
    df = spark.createDataFrame([("High Risk", 1), ("Low Risk", 2), ("Medium Risk", 3), (None, 4)], "risk_tier string, n int")
    got = [r[0] for r in tr.ordered(df, ["risk_tier"], {"risk_tier": TIER_ORDER}).collect()]
    assert got == ["Low Risk", "Medium Risk", "High Risk", None]


def test_report_formats(spark):
    from cardpanel.functions.columns import money_text, pct_text
    df = spark.createDataFrame([(56.08022, 11985677.42)], "p double, m double")
    r = df.select(pct_text("p").alias("p"), money_text("m").alias("m")).first()
    assert r["p"] == "56.1%" and r["m"] == "$11,985,677"


def test_size_for_input(spark):
    from cardpanel.session import input_bytes, size_for_input
    paths = [f"{SF001}/{t}.parquet" for t in ("customer", "orders", "lineitem")]
    assert input_bytes(spark, paths) > 0
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        s = size_for_input(spark, paths)
        assert int(s["spark.sql.shuffle.partitions"]) == spark.sparkContext.defaultParallelism  # tiny input
        s = size_for_input(spark, paths, target=1024)
        assert int(s["spark.sql.shuffle.partitions"]) > spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(128 * 1024 * 1024))
