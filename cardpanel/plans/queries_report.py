"""Registered queries: plot data, report figures, queues, extracts, drivers."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardpanel.operators import explain as ex
from cardpanel.operators import modeling as md
from cardpanel.operators import reporting as rp
from cardpanel.plans.catalog import _plan, register
from cardpanel.plans.queries_model import RANK_SQL
from cardpanel.schema import FEATURES

VIEW_SQL = """
acct AS (
  SELECT f.*, rt.risk_tier, rt.tier_reason, c.credit_limit, c.sex, c.education, c.marriage, c.age, o.default_next_month
  FROM credit_features f JOIN risk_tiers rt USING (customer_id) JOIN customers c USING (customer_id)
  JOIN outcomes o USING (customer_id)
)
"""


@register("account_view", """
SELECT customer_id, avg_utilization, utilization_trend, on_time_months, max_delinquency, delinquency_drift,
       consecutive_delays, payment_ratio, balance_volatility, risk_tier, tier_reason,
       CAST(credit_limit AS DOUBLE) AS credit_limit, CAST(sex AS INTEGER) AS sex, CAST(education AS INTEGER) AS education,
       CAST(marriage AS INTEGER) AS marriage, age, default_next_month
FROM acct""", VIEW_SQL, group="report")
def q_account_view(spark, sf_dir):
    v = _plan(spark, sf_dir).view
    return v.select(*[F.col(c).cast("double").alias(c) if t.startswith("decimal") else
                      (F.col(c).cast("int").alias(c) if t == "smallint" else F.col(c)) for c, t in v.dtypes])


@register("utilization_histogram", """
SELECT default_next_month, bin, lo + bin * w AS bin_left, lo + (bin + 1) * w AS bin_right, account_count,
       CASE WHEN w > 0 THEN account_count / (SUM(account_count) OVER (PARTITION BY default_next_month) * w)
            ELSE account_count / SUM(account_count) OVER (PARTITION BY default_next_month) END AS density
FROM (
  SELECT default_next_month, b AS bin, COUNT(*) AS account_count, MIN(lo) AS lo, MIN(w) AS w
  FROM (SELECT a.default_next_month, s.lo, s.w,
               CASE WHEN s.w > 0 THEN GREATEST(LEAST(CAST(
                 FLOOR((a.avg_utilization - s.lo) / s.w)
                 + CASE WHEN s.lo + (FLOOR((a.avg_utilization - s.lo) / s.w) + 1) * s.w <= a.avg_utilization THEN 1 ELSE 0 END
                 - CASE WHEN s.lo + FLOOR((a.avg_utilization - s.lo) / s.w) * s.w > a.avg_utilization THEN 1 ELSE 0 END
                 AS INTEGER), 39), 0) ELSE 0 END AS b
        FROM acct a, (SELECT MIN(avg_utilization) AS lo, (MAX(avg_utilization) - MIN(avg_utilization)) / 40.0 AS w
                      FROM acct) s) t
  GROUP BY default_next_month, b
) h""", VIEW_SQL, group="report")
def q_utilization_histogram(spark, sf_dir):
    p = _plan(spark, sf_dir)
    return rp.utilization_histogram(p.features.join(p.outcomes, "customer_id"))


def _melt_sql(src: str) -> str:
    return "\nUNION ALL ".join(
        f"SELECT customer_id, default_next_month, '{n}' AS feature_name, CAST({n} AS DOUBLE) AS v FROM {src}"
        for n in FEATURES)


@register("feature_boxplot_stats", """
SELECT q.feature_name, q.default_next_month, q.n, q.q1, q.median, q.q3,
       MIN(m.v) FILTER (WHERE m.v >= q.q1 - 1.5 * (q.q3 - q.q1)) AS whisker_low,
       MAX(m.v) FILTER (WHERE m.v <= q.q3 + 1.5 * (q.q3 - q.q1)) AS whisker_high,
       COUNT(*) FILTER (WHERE m.v < q.q1 - 1.5 * (q.q3 - q.q1) OR m.v > q.q3 + 1.5 * (q.q3 - q.q1)) AS outliers
FROM quart q JOIN melted_fv m USING (feature_name, default_next_month)
GROUP BY q.feature_name, q.default_next_month, q.n, q.q1, q.median, q.q3""",
          VIEW_SQL + f""",
melted_fv AS ({_melt_sql('acct')}),
ranked AS (
  SELECT feature_name, default_next_month, v,
         ROW_NUMBER() OVER (PARTITION BY feature_name, default_next_month ORDER BY v) - 1 AS rk,
         COUNT(*) OVER (PARTITION BY feature_name, default_next_month) AS n
  FROM melted_fv
),
quart AS (
  SELECT feature_name, default_next_month, n,
         MAX(v) FILTER (WHERE rk = FLOOR(CAST(0.25 AS DOUBLE) * CAST(n - 1 AS DOUBLE))) + (CAST(0.25 AS DOUBLE) * CAST(n - 1 AS DOUBLE) - FLOOR(CAST(0.25 AS DOUBLE) * CAST(n - 1 AS DOUBLE))) * (MAX(v) FILTER (WHERE rk = CEIL(CAST(0.25 AS DOUBLE) * CAST(n - 1 AS DOUBLE))) - MAX(v) FILTER (WHERE rk = FLOOR(CAST(0.25 AS DOUBLE) * CAST(n - 1 AS DOUBLE)))) AS q1,
         MAX(v) FILTER (WHERE rk = FLOOR(CAST(0.5 AS DOUBLE) * CAST(n - 1 AS DOUBLE))) + (CAST(0.5 AS DOUBLE) * CAST(n - 1 AS DOUBLE) - FLOOR(CAST(0.5 AS DOUBLE) * CAST(n - 1 AS DOUBLE))) * (MAX(v) FILTER (WHERE rk = CEIL(CAST(0.5 AS DOUBLE) * CAST(n - 1 AS DOUBLE))) - MAX(v) FILTER (WHERE rk = FLOOR(CAST(0.5 AS DOUBLE) * CAST(n - 1 AS DOUBLE)))) AS median,
         MAX(v) FILTER (WHERE rk = FLOOR(CAST(0.75 AS DOUBLE) * CAST(n - 1 AS DOUBLE))) + (CAST(0.75 AS DOUBLE) * CAST(n - 1 AS DOUBLE) - FLOOR(CAST(0.75 AS DOUBLE) * CAST(n - 1 AS DOUBLE))) * (MAX(v) FILTER (WHERE rk = CEIL(CAST(0.75 AS DOUBLE) * CAST(n - 1 AS DOUBLE))) - MAX(v) FILTER (WHERE rk = FLOOR(CAST(0.75 AS DOUBLE) * CAST(n - 1 AS DOUBLE)))) AS q3
  FROM ranked GROUP BY feature_name, default_next_month, n
)""", group="report")
def q_feature_boxplot_stats(spark, sf_dir):
    return rp.feature_boxplot_stats(_plan(spark, sf_dir).view)


@register("report_kpis", """
SELECT COUNT(*) AS accounts,
       AVG(CASE WHEN risk_tier = 'High Risk' THEN default_next_month END) * 100 AS high_default_rate_pct,
       AVG(CASE WHEN risk_tier = 'Medium Risk' THEN default_next_month END) * 100 AS medium_default_rate_pct,
       AVG(CASE WHEN risk_tier = 'Low Risk' THEN default_next_month END) * 100 AS low_default_rate_pct,
       AVG(CASE WHEN risk_tier = 'High Risk' THEN default_next_month END) * 100
         - AVG(CASE WHEN risk_tier = 'Low Risk' THEN default_next_month END) * 100 AS tier_spread_pp,
       COUNT(*) FILTER (WHERE risk_tier = 'High Risk') * 100.0 / COUNT(*) AS high_share_pct,
       CAST(SUM(CASE WHEN risk_tier = 'High Risk' THEN credit_limit END) AS DOUBLE) * (1.0 / 31.0) AS high_exposure_usd,
       CAST(SUM(CASE WHEN risk_tier = 'Medium Risk' THEN credit_limit END) AS DOUBLE) * (1.0 / 31.0) AS medium_exposure_usd,
       ROUND(AVG(CASE WHEN risk_tier = 'High Risk' THEN avg_utilization END), 10) AS high_avg_utilization,
       ROUND(AVG(CASE WHEN risk_tier = 'Low Risk' THEN avg_utilization END), 10) AS low_avg_utilization
FROM acct""", VIEW_SQL, group="report")
def q_report_kpis(spark, sf_dir):
    k = rp.report_kpis(_plan(spark, sf_dir).view)
    return k.withColumn("high_avg_utilization", F.round("high_avg_utilization", 10)) \
        .withColumn("low_avg_utilization", F.round("low_avg_utilization", 10))


@register("action_queue", """
SELECT CASE WHEN risk_tier = 'Medium Risk' AND (avg_utilization >= 0.85 OR 6 - on_time_months >= 2) THEN 'outreach'
            WHEN risk_tier = 'High Risk' AND (avg_utilization >= 0.85 OR max_delinquency >= 2) THEN 'limit_review' END
         AS queue,
       customer_id, risk_tier, avg_utilization, max_delinquency, on_time_months, CAST(credit_limit AS DOUBLE) AS credit_limit
FROM acct
WHERE (risk_tier = 'Medium Risk' AND (avg_utilization >= 0.85 OR 6 - on_time_months >= 2))
   OR (risk_tier = 'High Risk' AND (avg_utilization >= 0.85 OR max_delinquency >= 2))""", VIEW_SQL, group="report")
def q_action_queue(spark, sf_dir):
    return rp.action_queue(_plan(spark, sf_dir).view)


def _band_sql() -> str:
    e = rp.LIMIT_BANDS
    parts = []
    for i, lo in enumerate(e):
        if i + 1 < len(e):
            parts.append(f"WHEN credit_limit >= {lo} AND credit_limit < {e[i + 1]} THEN '{lo}-{e[i + 1]}'")
        else:
            parts.append(f"WHEN credit_limit >= {lo} THEN '{lo}+'")
    return "CASE " + " ".join(parts) + " END"


@register("account_explorer", f"""
SELECT a.customer_id, a.avg_utilization, s.risk_score, a.risk_tier, a.max_delinquency, a.on_time_months,
       CAST(a.credit_limit AS DOUBLE) AS credit_limit, {_band_sql()} AS limit_band, a.default_next_month
FROM acct a JOIN scores s USING (customer_id)""", VIEW_SQL, group="report")
def q_account_explorer(spark, sf_dir):
    return rp.account_explorer(_plan(spark, sf_dir).scored_view, None)


@register("top_risk_accounts", """
SELECT a.customer_id, a.risk_tier, s.risk_score, s.risk_score AS fraud_risk_score, a.avg_utilization,
       a.max_delinquency, a.on_time_months, CAST(a.credit_limit AS DOUBLE) AS credit_limit, a.default_next_month
FROM acct a JOIN scores s USING (customer_id)
ORDER BY s.risk_score DESC, a.customer_id LIMIT 500""", VIEW_SQL, group="report")
def q_top_risk_accounts(spark, sf_dir):
    return rp.top_risk_accounts(_plan(spark, sf_dir).scored_view, None, 500)


ATTR_SQL = """
means AS (SELECT AVG(CAST(avg_utilization AS DOUBLE)) AS mu, AVG(CAST(max_delinquency AS DOUBLE)) AS mm,
                 AVG(CAST(delinquency_drift AS DOUBLE)) AS md FROM credit_features),
attr AS (
  SELECT f.customer_id,
         0.4 * (CAST(f.avg_utilization AS DOUBLE) - m.mu) AS avg_utilization, 0.0 AS utilization_trend,
         0.0 AS on_time_months, 0.3 * (CAST(f.max_delinquency AS DOUBLE) - m.mm) AS max_delinquency,
         0.3 * (CAST(f.delinquency_drift AS DOUBLE) - m.md) AS delinquency_drift, 0.0 AS consecutive_delays,
         0.0 AS payment_ratio, 0.0 AS balance_volatility
  FROM credit_features f, means m
),
attr_long AS (
""" + "\nUNION ALL ".join(f"SELECT customer_id, '{n}' AS feature_name, {i} AS idx, {n} AS a FROM attr"
                          for i, n in enumerate(FEATURES)) + "\n)"


@register("attribution_importance", """
SELECT feature_name, mean_abs_value, CAST(ROW_NUMBER() OVER (ORDER BY mean_abs_value DESC, feature_name) AS INTEGER) AS rank
FROM (SELECT feature_name, ROUND(AVG(ABS(a)), 10) AS mean_abs_value FROM attr_long GROUP BY feature_name) t""",
          ATTR_SQL, group="explain")
def q_attribution_importance(spark, sf_dir):
    f = _plan(spark, sf_dir).features
    return ex.attribution_importance(ex.linear_attributions(f, ex.COMPOSITE_COEFS), digits=10) \
        .withColumn("rank", F.col("rank").cast("int"))


@register("top_drivers", """
SELECT t.customer_id, t.risk_score,
       MAX(CASE WHEN d.r = 1 THEN d.feature_name END) AS top_driver_1,
       MAX(CASE WHEN d.r = 2 THEN d.feature_name END) AS top_driver_2,
       MAX(CASE WHEN d.r = 3 THEN d.feature_name END) AS top_driver_3
FROM (SELECT s.customer_id, s.risk_score FROM scores s JOIN ranked k USING (customer_id)
      WHERE k.rk < ROUND(0.2 * k.n)
      ORDER BY s.risk_score DESC, s.customer_id LIMIT 20) t
JOIN (SELECT customer_id, feature_name,
             ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY ABS(a) DESC, idx DESC) AS r FROM attr_long) d
  USING (customer_id)
GROUP BY t.customer_id, t.risk_score""", ATTR_SQL + "," + RANK_SQL, group="explain")
def q_top_drivers(spark, sf_dir):
    """Top 20 TEST-split accounts by score with their three largest linear
    drivers (the attribution means come from all accounts)."""
    p = _plan(spark, sf_dir)
    attr = ex.linear_attributions(p.features, ex.COMPOSITE_COEFS)
    test = md.stratified_split(p.features.join(p.outcomes, "customer_id")).filter(F.col("split") == "test")
    return ex.top_drivers(p.scores.join(test.select("customer_id"), "customer_id"), attr, 20)
