"""Report and dashboard tables: plot data, KPIs, queues, extracts, top-n.

Plot data only (histogram densities, box-plot statistics, correlation
matrix); drawing is left to the dashboard tool.  Quantiles are exact and
distributed (``quantiles.class_quantiles``), never a collected group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardpanel.operators.quantiles import class_quantiles
from cardpanel.schema import FEATURES, MONTHS, TIER_HIGH, TIER_LOW, TIER_MEDIUM, TWD_PER_USD

# Box-plot whisker reach and quartiles.
WHISKER = 1.5
QUARTILES = (0.25, 0.5, 0.75)
# Action-queue thresholds named in the report (utilization
# near 85%, two delayed months, 60 days past due).
QUEUE_UTIL, QUEUE_DELAYS, QUEUE_WORST = 0.85, 2, 2


def utilization_histogram(view: DataFrame, value: str = "avg_utilization", label: str = "default_next_month",
                          bins: int = 40) -> DataFrame:
    """Common equal-width bins over the full range; each class normalised to
    density 1 (count / (class size x bin width)).  The range and class sizes
    are scalar subqueries: computed once, no join with the rows."""
    rng = view.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()  # one subquery
    lo, hi = rng["lo"], rng["hi"]
    width = (hi - lo) / F.lit(float(bins))
    v = F.col(value).cast("double")
    # first guess, then corrected against the edge values lo + i*w themselves
    i0 = F.floor((v - lo) / width)
    up = (lo + (i0 + 1) * width) <= v
    down = (lo + i0 * width) > v
    raw = (i0 + F.when(up, 1).otherwise(0) - F.when(down, 1).otherwise(0)).cast("int")
    b = F.when(width > 0, F.greatest(F.least(raw, F.lit(bins - 1)), F.lit(0))).otherwise(F.lit(0))
    counts = view.select(F.col(label), b.alias("bin")).groupBy(label, "bin").agg(
        F.count(F.lit(1)).alias("account_count"))
    class_n = F.sum("account_count").over(Window.partitionBy(label))  # bounded: classes x bins rows
    return counts.select(
        label, "bin", (lo + F.col("bin") * width).alias("bin_left"), (lo + (F.col("bin") + 1) * width).alias("bin_right"),
        "account_count",
        F.when(width > 0, F.col("account_count") / (class_n * width)).otherwise(F.col("account_count") / class_n)
        .alias("density"))


def feature_boxplot_stats(view: DataFrame, names=FEATURES, label: str = "default_next_month") -> DataFrame:
    """Per (feature, class): n, q1, median, q3 (linear interpolation between
    order statistics), whiskers (most extreme values within 1.5 IQR of the
    quartiles) and the outlier count.  One row a feature and class, from four
    aggregations of the view: sketch, counts below and inside the brackets, fences."""
    names = list(names)
    quartiles = class_quantiles(view, names, label, QUARTILES)
    kind = view.schema[label].dataType.simpleString()
    classes = list(dict.fromkeys(c for c, _ in quartiles))
    fence = {k: (q1 - WHISKER * (q3 - q1), q3 + WHISKER * (q3 - q1)) for k, (_, (q1, _, q3)) in quartiles.items()}
    edges = view.sparkSession.createDataFrame(
        [(c, *[x for name in names for x in fence.get((c, name), (None, None))]) for c in classes],
        f"__class {kind}, " + ", ".join(f"__lo_{i} double, __hi_{i} double" for i in range(len(names))))
    met = view.select(label, *[F.col(c).cast("double").alias(c) for c in names]).join(edges, F.col(label).eqNullSafe(F.col("__class")))
    aggs = []
    for i, c in enumerate(names):
        v, lo, hi = F.col(c), F.col(f"__lo_{i}"), F.col(f"__hi_{i}")
        aggs += [F.min(F.when(v >= lo, v)).alias(f"low_{i}"), F.max(F.when(v <= hi, v)).alias(f"high_{i}"),
                 F.count_if((v < lo) | (v > hi)).alias(f"out_{i}")]
    reach = {r[label]: r for r in met.groupBy(label).agg(*aggs).collect()}  # one row a class
    rows = [(name, c, n, *q, reach[c][f"low_{i}"], reach[c][f"high_{i}"], reach[c][f"out_{i}"])
            for i, name in enumerate(names) for c in classes if (c, name) in quartiles for n, q in [quartiles[c, name]]]
    return view.sparkSession.createDataFrame(rows, f"feature_name string, {label} {kind}, n long, q1 double, median double, q3 double, "
                                                   "whisker_low double, whisker_high double, outliers long")


def report_kpis(view: DataFrame, fx_rate: float = TWD_PER_USD) -> DataFrame:
    """Memo figures in one pass: default rate per tier, High-Low spread,
    High share, exposure per tier (USD), mean utilization per tier."""
    n = F.count(F.lit(1))
    tier = F.col("risk_tier")

    def rate(t):
        return F.avg(F.when(tier == t, F.col("default_next_month"))) * 100

    def exposure(t):
        return F.sum(F.when(tier == t, F.col("credit_limit"))).cast("double") * F.lit(1.0 / fx_rate)

    return view.agg(
        n.alias("accounts"),
        rate(TIER_HIGH).alias("high_default_rate_pct"),
        rate(TIER_MEDIUM).alias("medium_default_rate_pct"),
        rate(TIER_LOW).alias("low_default_rate_pct"),
        (rate(TIER_HIGH) - rate(TIER_LOW)).alias("tier_spread_pp"),
        F.try_divide(F.count_if(tier == TIER_HIGH) * 100.0, n).alias("high_share_pct"),
        exposure(TIER_HIGH).alias("high_exposure_usd"),
        exposure(TIER_MEDIUM).alias("medium_exposure_usd"),
        F.avg(F.when(tier == TIER_HIGH, F.col("avg_utilization"))).alias("high_avg_utilization"),
        F.avg(F.when(tier == TIER_LOW, F.col("avg_utilization"))).alias("low_avg_utilization"))


def action_queue(view: DataFrame, util: float = QUEUE_UTIL, delayed: int = QUEUE_DELAYS, worst: int = QUEUE_WORST,
                 months: int = MONTHS) -> DataFrame:
    """Accounts routed to the report's two work queues:
    outreach   - Medium Risk with utilization >= util or >= ``delayed`` months
                 not on time;
    limit review - High Risk with utilization >= util or worst status >=
                 ``worst`` (60 days past due or more)."""
    u, late = F.col("avg_utilization"), F.lit(months) - F.col("on_time_months")
    tier = F.col("risk_tier")
    queue = (F.when((tier == TIER_MEDIUM) & ((u >= util) | (late >= delayed)), F.lit("outreach"))
             .when((tier == TIER_HIGH) & ((u >= util) | (F.col("max_delinquency") >= worst)), F.lit("limit_review")))
    return view.select(queue.alias("queue"), "customer_id", "risk_tier", "avg_utilization", "max_delinquency",
                       "on_time_months", F.col("credit_limit").cast("double").alias("credit_limit")).filter(
        F.col("queue").isNotNull())


# Credit limit bands (TWD) for the account explorer filter.
LIMIT_BANDS = [0, 50_000, 100_000, 200_000, 500_000]


def limit_band(col="credit_limit", edges=LIMIT_BANDS):
    c = F.col(col)
    expr = None
    for i, lo in enumerate(edges):
        hi = edges[i + 1] if i + 1 < len(edges) else None
        label = f"{lo}+" if hi is None else f"{lo}-{hi}"
        cond = (c >= lo) if hi is None else ((c >= lo) & (c < hi))
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr


def _with_score(view: DataFrame, scores: DataFrame | None) -> DataFrame:
    """The view with its score: joined from ``scores``, or already a column of
    the view (``scores=None``), which avoids re-joining the same keys."""
    if scores is None:
        return view
    return view.join(scores.select("customer_id", "risk_score"), "customer_id")


def account_explorer(view: DataFrame, scores: DataFrame | None, edges=LIMIT_BANDS) -> DataFrame:
    """Scatter extract: utilization vs score by tier, with the tooltip fields
    and a credit-limit band for filtering."""
    j = _with_score(view, scores)
    return j.select("customer_id", "avg_utilization", "risk_score", "risk_tier", "max_delinquency", "on_time_months",
                    F.col("credit_limit").cast("double").alias("credit_limit"),
                    limit_band("credit_limit", edges).alias("limit_band"), "default_next_month")


def top_risk_accounts(view: DataFrame, scores: DataFrame | None, n: int = 500) -> DataFrame:
    """Top n accounts by score (ties: customer_id) in the export layout; the
    score appears under both of its published names."""
    j = _with_score(view, scores)
    return (j.select("customer_id", "risk_tier", "risk_score", F.col("risk_score").alias("fraud_risk_score"),
                     "avg_utilization", "max_delinquency", "on_time_months",
                     F.col("credit_limit").cast("double").alias("credit_limit"), "default_next_month")
            .orderBy(F.col("risk_score").desc(), F.col("customer_id").asc()).limit(n))
