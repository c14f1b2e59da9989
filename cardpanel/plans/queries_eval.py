"""Registered queries: evaluation of the deterministic heuristic score.

The heuristic probability (composite of utilization, worst status and drift)
stands in for a model score so that every metric can be checked against SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cardpanel.operators import evaluation as ev
from cardpanel.plans.catalog import _plan, register

CURVE_SQL = """
curve AS (
  SELECT CAST(g.i AS DOUBLE) / 100.0 AS threshold,
         COUNT(*) FILTER (WHERE s.default_next_month = 1 AND s.risk_score < CAST(g.i AS DOUBLE) / 100.0) AS fn,
         COUNT(*) FILTER (WHERE s.default_next_month = 0 AND s.risk_score >= CAST(g.i AS DOUBLE) / 100.0) AS fp
  FROM range(10, 91) g(i) CROSS JOIN scores s GROUP BY g.i
),
cost AS (SELECT threshold, fn, fp, 150 * fn + 10 * fp AS total_cost FROM curve)
"""
RUN_SQL = """
by_score AS (SELECT risk_score, COUNT(*) AS n, CAST(SUM(default_next_month) AS BIGINT) AS tp FROM scores GROUP BY risk_score),
run AS (
  SELECT risk_score, n, tp,
         SUM(n) OVER (ORDER BY risk_score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n_cum,
         SUM(tp) OVER (ORDER BY risk_score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp_cum
  FROM by_score
)
"""


def _scores(spark, sf_dir):
    return _plan(spark, sf_dir).scores


@register("risk_scores", "SELECT customer_id, default_next_month, risk_score FROM scores", group="evaluation")
def q_risk_scores(spark, sf_dir):
    return _scores(spark, sf_dir)


@register("cost_curve", "SELECT threshold, fn, fp, total_cost FROM cost", CURVE_SQL, group="evaluation")
def q_cost_curve(spark, sf_dir):
    return ev.cost_curve(_scores(spark, sf_dir))


@register("optimal_threshold", "SELECT threshold, fn, fp, total_cost FROM cost ORDER BY total_cost, threshold LIMIT 1",
          CURVE_SQL, group="evaluation")
def q_optimal_threshold(spark, sf_dir):
    return ev.optimal_threshold(ev.cost_curve(_scores(spark, sf_dir)))


@register("cost_at_reference", """
SELECT threshold, fn, fp, total_cost FROM cost ORDER BY ABS(threshold - 0.5), threshold LIMIT 1""",
          CURVE_SQL, group="evaluation")
def q_cost_at_reference(spark, sf_dir):
    return ev.cost_at(ev.cost_curve(_scores(spark, sf_dir)), 0.5)


@register("average_precision", """
SELECT ROUND(SUM(CAST(tp AS DOUBLE) * CAST(tp_cum AS DOUBLE) / CAST(n_cum AS DOUBLE)) / SUM(tp), 10) AS average_precision
FROM run""", RUN_SQL, group="evaluation")
def q_average_precision(spark, sf_dir):
    ap = ev.average_precision(_scores(spark, sf_dir))
    return ap.select(F.round("average_precision", 10).alias("average_precision"))


@register("pr_curve", """
SELECT risk_score AS threshold, CAST(tp_cum AS DOUBLE) / n_cum AS precision,
       CAST(tp_cum AS DOUBLE) / (SELECT SUM(tp) FROM by_score) AS recall, tp
FROM run""", RUN_SQL, group="evaluation")
def q_pr_curve(spark, sf_dir):
    return ev.pr_curve(_scores(spark, sf_dir))


CONF_SQL = """
conf AS (
  SELECT COUNT(*) FILTER (WHERE risk_score < 0.5 AND default_next_month = 0) AS tn,
         COUNT(*) FILTER (WHERE risk_score >= 0.5 AND default_next_month = 0) AS fp,
         COUNT(*) FILTER (WHERE risk_score < 0.5 AND default_next_month = 1) AS fn,
         COUNT(*) FILTER (WHERE risk_score >= 0.5 AND default_next_month = 1) AS tp
  FROM scores
),
cd AS (SELECT CAST(tn AS DOUBLE) AS tn, CAST(fp AS DOUBLE) AS fp, CAST(fn AS DOUBLE) AS fn, CAST(tp AS DOUBLE) AS tp FROM conf),
pr AS (
  SELECT *, tn + fp + fn + tp AS n,
         CASE WHEN tn + fn <> 0 THEN tn / (tn + fn) ELSE 0.0 END AS p0,
         CASE WHEN tn + fp <> 0 THEN tn / (tn + fp) ELSE 0.0 END AS r0,
         CASE WHEN tp + fp <> 0 THEN tp / (tp + fp) ELSE 0.0 END AS p1,
         CASE WHEN tp + fn <> 0 THEN tp / (tp + fn) ELSE 0.0 END AS r1
  FROM cd
),
f AS (
  SELECT *, CASE WHEN p0 + r0 <> 0 THEN 2 * p0 * r0 / (p0 + r0) ELSE 0.0 END AS f0,
            CASE WHEN p1 + r1 <> 0 THEN 2 * p1 * r1 / (p1 + r1) ELSE 0.0 END AS f1,
            tn + fp AS s0, tp + fn AS s1,
            CASE WHEN tn + fp + fn + tp <> 0 THEN (tn + tp) / (tn + fp + fn + tp) ELSE 0.0 END AS acc
  FROM pr
)
"""


@register("confusion", "SELECT tn, fp, fn, tp FROM conf", CONF_SQL, group="evaluation")
def q_confusion(spark, sf_dir):
    return ev.confusion(_scores(spark, sf_dir), 0.5)


@register("classification_report", """
SELECT '0' AS class_name, p0 AS precision, r0 AS recall, f0 AS f1_score, CAST(s0 AS BIGINT) AS support FROM f
UNION ALL SELECT '1', p1, r1, f1, CAST(s1 AS BIGINT) FROM f
UNION ALL SELECT 'accuracy', acc, acc, acc, CAST(n AS BIGINT) FROM f
UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, CAST(n AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg',
       CASE WHEN n <> 0 THEN (p0 * s0 + p1 * s1) / n ELSE 0.0 END,
       CASE WHEN n <> 0 THEN (r0 * s0 + r1 * s1) / n ELSE 0.0 END,
       CASE WHEN n <> 0 THEN (f0 * s0 + f1 * s1) / n ELSE 0.0 END, CAST(n AS BIGINT) FROM f""",
          CONF_SQL, group="evaluation")
def q_classification_report(spark, sf_dir):
    return ev.classification_report(ev.confusion(_scores(spark, sf_dir), 0.5))


@register("fbeta_at_optimum", """
SELECT tn, fp, fn, tp,
       CASE WHEN 5.0 * tp + 4.0 * fn + fp <> 0 THEN 5.0 * tp / (5.0 * tp + 4.0 * fn + fp) ELSE 0.0 END AS fbeta
FROM (SELECT CAST(COUNT(*) FILTER (WHERE risk_score < t AND default_next_month = 0) AS DOUBLE) AS tn,
             CAST(COUNT(*) FILTER (WHERE risk_score >= t AND default_next_month = 0) AS DOUBLE) AS fp,
             CAST(COUNT(*) FILTER (WHERE risk_score < t AND default_next_month = 1) AS DOUBLE) AS fn,
             CAST(COUNT(*) FILTER (WHERE risk_score >= t AND default_next_month = 1) AS DOUBLE) AS tp
      FROM scores, (SELECT threshold AS t FROM cost ORDER BY total_cost, threshold LIMIT 1) b) c""",
          CURVE_SQL, group="evaluation")
def q_fbeta_at_optimum(spark, sf_dir):
    scores = _scores(spark, sf_dir)
    best = ev.optimal_threshold(ev.cost_curve(scores)).select("threshold").scalar()
    conf = ev.confusion(scores, best)
    conf = conf.select(*[F.col(c).cast("double").alias(c) for c in ("tn", "fp", "fn", "tp")])
    return ev.fbeta(conf, 2.0)


@register("class_weights", """
SELECT default_next_month, n, CAST(SUM(n) OVER () AS DOUBLE) / (COUNT(*) OVER () * n) AS weight,
       CAST(SUM(CASE WHEN default_next_month = 0 THEN n END) OVER () AS DOUBLE)
         / SUM(CASE WHEN default_next_month = 1 THEN n END) OVER () AS imbalance_ratio
FROM (SELECT default_next_month, COUNT(*) AS n FROM outcomes GROUP BY default_next_month) g""", group="evaluation")
def q_class_weights(spark, sf_dir):
    return ev.class_weights(_plan(spark, sf_dir).outcomes)


def _bins_sql() -> str:
    edges = ev.score_bins()
    cases = " ".join(f"WHEN risk_score <= {edges[i]!r} THEN {i}" for i in range(1, len(edges)))
    labels = []
    for i in range(1, len(edges)):
        a = round(edges[i - 1] - 0.001, 3) if i == 1 else round(edges[i - 1], 3)
        labels.append(f"WHEN {i} THEN '({a!r}, {round(edges[i], 3)!r}]'")
    return f"""
SELECT CASE g.bin {' '.join(labels)} END AS risk_score_bucket,
       COALESCE(c.account_count, 0) AS account_count, CAST(COALESCE(c.default_count, 0) AS BIGINT) AS default_count,
       CASE WHEN COALESCE(c.account_count, 0) > 0 THEN CAST(c.default_count AS DOUBLE) / c.account_count * 100
            ELSE 0.0 END AS default_rate_pct
FROM range(1, {len(edges)}) g(bin)
LEFT JOIN (SELECT CASE WHEN risk_score < {edges[0]!r} THEN NULL {cases} END AS bin,
                  COUNT(customer_id) AS account_count, SUM(default_next_month) AS default_count
           FROM scores GROUP BY 1) c ON c.bin = g.bin"""


@register("score_distribution", _bins_sql(), group="evaluation")
def q_score_distribution(spark, sf_dir):
    return ev.score_distribution(_scores(spark, sf_dir))
