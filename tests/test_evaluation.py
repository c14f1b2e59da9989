from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from cardpanel.operators import evaluation as ev
from cardpanel.operators.ordered import exact_ranks, running_sums


def _scored(spark, scores, labels):
    return spark.createDataFrame([(i, float(s), int(y)) for i, (s, y) in enumerate(zip(scores, labels))],
                                 "customer_id long, risk_score double, default_next_month int")


def test_average_precision_toy(spark):
    s = _scored(spark, [0.9, 0.9, 0.8, 0.3, 0.2], [1, 0, 1, 0, 1])
    assert ev.average_precision(s, rows_per_block=2).first()[0] == pytest.approx(0.588889, abs=1e-6)


def _brute_ap(scores, labels):
    pos = sum(labels)
    ap = 0.0
    for t in sorted(set(scores), reverse=True):
        sel = [y for s, y in zip(scores, labels) if s >= t]
        tp_here = sum(y for s, y in zip(scores, labels) if s == t)
        ap += tp_here / pos * (sum(sel) / len(sel))
    return ap


@pytest.mark.parametrize("rows_per_block", [7, 40, 10_000])
def test_average_precision_matches_brute_force(spark, rows_per_block):
    rnd = random.Random(rows_per_block)
    scores = [round(rnd.random(), 2) for _ in range(300)]
    labels = [int(rnd.random() < s) for s in scores]
    got = ev.average_precision(_scored(spark, scores, labels), rows_per_block=rows_per_block).first()[0]
    assert got == pytest.approx(_brute_ap(scores, labels), rel=1e-12)


def test_cost_curve_matches_brute_force(spark):
    rnd = random.Random(7)
    scores = [rnd.choice([0.1, 0.29, 0.3, 0.5, 0.90, 0.905, 0.0999]) if rnd.random() < 0.3 else rnd.random()
              for _ in range(400)]
    labels = [int(rnd.random() < 0.3) for _ in scores]
    curve = {round(r["threshold"], 2): (r["fn"], r["fp"], r["total_cost"])
             for r in ev.cost_curve(_scored(spark, scores, labels)).collect()}
    assert len(curve) == 81
    for i in range(10, 91):
        t = i / 100
        fn = sum(1 for s, y in zip(scores, labels) if y == 1 and s < t)
        fp = sum(1 for s, y in zip(scores, labels) if y == 0 and s >= t)
        assert curve[round(t, 2)] == (fn, fp, 150 * fn + 10 * fp)
    vals = [curve[round(i / 100, 2)] for i in range(10, 91)]
    assert all(a[0] <= b[0] and a[1] >= b[1] for a, b in zip(vals, vals[1:]))  # fn never falls, fp never rises


def test_threshold_tie_takes_lowest(spark):
    curve = spark.createDataFrame([(0.1, 1, 0, 150), (0.2, 0, 15, 150), (0.3, 2, 0, 300)],
                                  "threshold double, fn long, fp long, total_cost long")
    assert ev.optimal_threshold(curve).first()["threshold"] == 0.1
    assert ev.cost_at(curve, 0.25).first()["threshold"] == 0.2


def test_confusion_goldens(spark):
    conf = spark.createDataFrame([(362, 4311, 33, 1294)], "tn long, fp long, fn long, tp long")
    assert ev.fbeta(conf, 2.0).first()["fbeta"] == pytest.approx(0.59287, abs=5e-6)
    assert 33 * 150 + 4311 * 10 == 48060
    rep = {r["class_name"]: r for r in ev.classification_report(conf).collect()}
    assert rep["1"]["recall"] == pytest.approx(1294 / 1327)
    assert rep["accuracy"]["support"] == 6000


def test_score_distribution_keeps_empty_bins(spark):
    s = _scored(spark, [0.0, 0.05, 0.1, 0.95, 1.0], [0, 1, 0, 1, 1])
    d = {r["risk_score_bucket"]: r for r in ev.score_distribution(s).collect()}
    assert len(d) == 10
    assert d["(-0.001, 0.1]"]["account_count"] == 3 and d["(-0.001, 0.1]"]["default_count"] == 1
    assert d["(0.5, 0.6]"]["account_count"] == 0 and d["(0.5, 0.6]"]["default_rate_pct"] == 0.0
    assert d["(0.9, 1.0]"]["default_rate_pct"] == 100.0


def test_running_sums_and_ranks_exact(spark):
    rnd = random.Random(3)
    rows = [(rnd.randint(0, 2), float(rnd.randint(0, 40)), rnd.randint(0, 1)) for _ in range(500)]
    df = spark.createDataFrame(rows, "g int, v double, y int")
    r = running_sums(df, "v", {"n": F.lit(1), "y": F.col("y")}, group_cols=["g"], rows_per_block=9)
    for row in r.collect():
        exp_n = sum(1 for g, v, _ in rows if g == row["g"] and v <= row["v"])
        exp_y = sum(y for g, v, y in rows if g == row["g"] and v <= row["v"])
        assert (row["n_cum"], row["y_cum"]) == (exp_n, exp_y)
    keyed = spark.createDataFrame([(i, rnd.randint(0, 1), rnd.random()) for i in range(300)], "id long, g int, h double")
    ranks = exact_ranks(keyed, ["h", "id"], ["g"], rows_per_block=13).collect()
    for g in (0, 1):
        got = sorted((r["rank"], r["h"]) for r in ranks if r["g"] == g)
        assert [x for x, _ in got] == list(range(len(got)))
        assert [h for _, h in got] == sorted(h for _, h in got)


def test_class_weights_balanced(spark):
    df = spark.createDataFrame([(i, int(i < 25)) for i in range(100)], "customer_id long, default_next_month int")
    w = {r["default_next_month"]: r for r in ev.class_weights(df).collect()}
    assert w[1]["weight"] == 2.0 and w[0]["weight"] == pytest.approx(100 / 150)
    assert w[0]["imbalance_ratio"] == 3.0


def test_metrics_without_positives_are_null_not_errors(spark):
    s = _scored(spark, [0.9, 0.5, 0.1], [0, 0, 0])
    assert ev.average_precision(s).first()[0] is None
    assert all(r["recall"] is None for r in ev.pr_curve(s).collect())
    assert ev.cost_curve(s).count() == 81


def test_running_sums_across_small_arrow_batches(spark):
    """Carry of running totals from one Arrow batch to the next, with groups
    that start, span and end inside batches."""
    rnd = random.Random(11)
    rows = [(rnd.randint(0, 3), float(rnd.randint(0, 60)), rnd.randint(0, 2)) for _ in range(700)]
    df = spark.createDataFrame(rows, "g int, v double, y int")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        r = running_sums(df, "v", {"n": F.lit(1), "y": F.col("y")}, group_cols=["g"], descending=True,
                         rows_per_block=50).collect()
        ranks = exact_ranks(df.withColumn("id", F.monotonically_increasing_id()), ["v", "id"], ["g"],
                            rows_per_block=40).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for row in r:
        assert row["n_cum"] == sum(1 for g, v, _ in rows if g == row["g"] and v >= row["v"])
        assert row["y_cum"] == sum(y for g, v, y in rows if g == row["g"] and v >= row["v"])
    for g in range(4):
        got = sorted(x["rank"] for x in ranks if x["g"] == g)
        assert got == list(range(len(got)))
