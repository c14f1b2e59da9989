from __future__ import annotations

import os
import tempfile

from pyspark.sql import functions as F

from cardpanel.operators.features import credit_features
from cardpanel.plans.portfolio import PortfolioPlan
from cardpanel.streaming import monthly_scoring as ms
from tests.conftest import SF001


def test_monthly_scoring_incremental(spark):
    p = PortfolioPlan(spark, SF001, materialize=False)
    root = tempfile.mkdtemp(prefix="cardpanel-stream-")
    incoming, panel_path, scores = (os.path.join(root, x) for x in ("incoming", "panel", "scores"))
    p.panel.filter(F.col("month_number") >= 4).write.parquet(os.path.join(incoming, "part1"))
    ms.start(spark, incoming, p.customers, panel_path, scores, name="t1")
    first = spark.read.parquet(scores)
    assert first.select("batch_id").distinct().count() == 1
    p.panel.filter(F.col("month_number") < 4).write.parquet(os.path.join(incoming, "part2"))
    ms.start(spark, incoming, p.customers, panel_path, scores, name="t1")
    all_scores = spark.read.parquet(scores)
    assert all_scores.select("batch_id").distinct().count() == 2
    latest = all_scores.filter(F.col("batch_id") == all_scores.agg(F.max("batch_id")).first()[0]).drop("batch_id",
                                                                                                     "risk_tier", "tier_reason")
    expected = credit_features(p.panel, p.customers)
    got = sorted(tuple(r) for r in latest.select(*expected.columns).collect())
    assert got == sorted(tuple(r) for r in expected.collect())
    assert ms.current_panel(spark, panel_path).count() == p.panel.count()
    # replaying the last epoch rebuilds the same version
    ms.score_batch(p.panel.filter(F.col("month_number") < 4), 1, p.customers, panel_path, scores)
    assert ms.current_panel(spark, panel_path).count() == p.panel.count()
