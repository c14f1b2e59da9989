"""Rule-based risk tiers and the tier / portfolio summaries.

Tier rules are data: an ordered list of (condition, tier, reason); the first
matching rule wins for both the tier and the reason.  Assignment is a narrow
projection (no shuffle).  Summaries group by the three tier names, so after
the partial aggregation only a handful of rows cross the network.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardpanel.functions.columns import fx
from cardpanel.schema import TIER_HIGH, TIER_LOW, TIER_MEDIUM, TIER_ORDER, TWD_PER_USD


@dataclass(frozen=True)
class TierRule:
    condition: str  # Spark SQL boolean expression over feature columns
    tier: str
    reason: str


# Tier rules in evaluation order, and the fallback.
DEFAULT_RULES = [
    TierRule("avg_utilization > 1.00", TIER_HIGH, "Average utilization above 100%"),
    TierRule("max_delinquency >= 3", TIER_HIGH, "At least 90-DPD observed"),
    TierRule("consecutive_delays >= 3", TIER_HIGH, "Three or more consecutive delayed months"),
    TierRule("avg_utilization < 0.40 AND on_time_months >= 5 AND max_delinquency <= 0", TIER_LOW,
             "Low utilization with strong on-time history"),
]
FALLBACK = (TIER_MEDIUM, "Intermediate behavioral risk")


def _first_match(rules, pick, default: str) -> Column:
    expr = None
    for r in rules:
        cond = F.expr(r.condition)
        expr = F.when(cond, pick(r)) if expr is None else expr.when(cond, pick(r))
    return expr.otherwise(default) if expr is not None else F.lit(default)


def assign_tiers(features: DataFrame, rules=DEFAULT_RULES, fallback=FALLBACK, keep_features: bool = False) -> DataFrame:
    tier = _first_match(rules, lambda r: r.tier, fallback[0]).alias("risk_tier")
    reason = _first_match(rules, lambda r: r.reason, fallback[1]).alias("tier_reason")
    if keep_features:
        return features.select("*", tier, reason)
    return features.select("customer_id", tier, reason)


def tier_rank(col="risk_tier", order=TIER_ORDER) -> Column:
    """Ordinal of a custom category order (Low, Medium, High) for sorting."""
    c = F.col(col) if isinstance(col, str) else col
    return F.array_position(F.array(*[F.lit(x) for x in order]), c)


def _rate(digits):
    r = F.avg(F.col("default_next_month")) * 100
    return F.round(r, digits) if digits is not None else r


def tier_default_rate(tiers: DataFrame, outcomes: DataFrame, digits: int | None = 2) -> DataFrame:
    return (tiers.join(outcomes, "customer_id").groupBy("risk_tier")
            .agg(F.count(F.lit(1)).alias("account_count"), _rate(digits).alias("default_rate_pct")))


def tier_exposure(tiers: DataFrame, customers: DataFrame) -> DataFrame:
    """Average and total limit per tier (TWD), exact decimal sums."""
    j = tiers.join(customers, "customer_id")
    total = F.sum("credit_limit")
    return j.groupBy("risk_tier").agg(
        F.round(total / F.count(F.lit(1)), 2).cast("double").alias("avg_credit_limit"),
        total.cast("double").alias("total_credit_exposure_twd"))


def high_risk_max_loss(tiers: DataFrame, customers: DataFrame, tier: str = TIER_HIGH) -> DataFrame:
    j = tiers.filter(F.col("risk_tier") == tier).join(customers, "customer_id")
    return j.agg(F.coalesce(F.sum("credit_limit"), F.lit(0)).cast("double").alias("high_risk_max_possible_loss_twd"))


def pct_of_total(grouped: DataFrame, n_col: str, out: str, digits: int | None = None) -> DataFrame:
    """Share of each row's count in the grand total, computed AFTER the
    aggregation (a window with no partition is only valid on a bounded,
    already-aggregated frame such as the three tiers)."""
    share = F.col(n_col) * F.lit(100.0) / F.sum(n_col).over(Window.partitionBy())
    return grouped.withColumn(out, F.round(share, digits) if digits is not None else share)


def tier_share(tiers: DataFrame, digits: int | None = 2) -> DataFrame:
    g = tiers.groupBy("risk_tier").agg(F.count(F.lit(1)).alias("account_count"))
    return pct_of_total(g, "account_count", "pct_of_portfolio", digits)


def tier_demographics(tiers: DataFrame, customers: DataFrame, digits: int | None = 2) -> DataFrame:
    j = tiers.join(customers, "customer_id")

    def r(c):
        return F.round(c, digits) if digits is not None else c
    return j.groupBy("risk_tier").agg(
        r(F.avg("age")).alias("avg_age"),
        r(F.avg((F.col("sex") == 2).cast("int")) * 100).alias("pct_female"),
        r(F.avg((F.col("education") == 1).cast("int")) * 100).alias("pct_graduate_educated"))


def account_view(features: DataFrame, tiers: DataFrame | None, customers: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Features + tier + limit/demographics + label, all keyed by customer_id.

    With ``tiers=None`` the tier columns are computed on the feature rows
    (a projection) instead of joining the tier table back to the features it
    came from.  The remaining inner joins share one key, so Spark plans them
    over a single hash partitioning of customer_id (features come out of
    their aggregation already partitioned by it)."""
    if tiers is None:
        base = assign_tiers(features, keep_features=True)
    else:
        base = features.join(tiers.select("customer_id", "risk_tier", "tier_reason"), "customer_id")
    return (base.join(customers.select("customer_id", "credit_limit", "sex", "education", "marriage", "age"),
                      "customer_id")
            .join(outcomes, "customer_id"))


def portfolio_overview(view: DataFrame, currency: str = "USD", digits: bool = True,
                       fx_rate: float = TWD_PER_USD) -> DataFrame:
    """Tier summary for the dashboard.

    currency="USD", digits=True: dashboard export rules - limits converted to
      USD before averaging, every measure rounded (2 dp, utilization 4 dp).
    currency="TWD", digits=False: local rules - average limit in TWD, total
      exposure converted, nothing rounded.
    ``view`` is ``account_view(...)``.
    """
    n = F.count(F.lit(1))
    limit_sum = F.sum("credit_limit")
    if currency == "USD":
        avg_limit = F.avg(fx("credit_limit", fx_rate))
        total = F.sum(fx("credit_limit", fx_rate))
    elif currency == "TWD":
        avg_limit = limit_sum.cast("double") / n
        total = limit_sum.cast("double") * F.lit(1.0 / fx_rate)
    else:
        raise ValueError("currency must be USD or TWD")
    measures = [
        (n, "account_count", None),
        (F.avg("default_next_month") * 100, "default_rate_pct", 2),
        (avg_limit, "avg_credit_limit", 2),
        (total, "total_exposure_usd", 2),
        (F.avg("avg_utilization"), "avg_utilization", 4),
        (F.avg("on_time_months"), "avg_on_time_months", 2),
    ]
    aggs = []
    for expr, name, d in measures:
        aggs.append((F.round(expr, d) if (digits and d is not None) else expr).alias(name))
    g = view.groupBy(F.col("risk_tier").alias("tier_name")).agg(*aggs)
    g = pct_of_total(g, "account_count", "pct_of_portfolio", 2 if digits else None)
    return g.select("tier_name", "account_count", "pct_of_portfolio", "default_rate_pct", "avg_credit_limit",
                    "total_exposure_usd", "avg_utilization", "avg_on_time_months")


def portfolio_kpis(view: DataFrame, fx_rate: float = TWD_PER_USD, high: str = TIER_HIGH) -> DataFrame:
    """Headline cards: accounts, default rate, exposure (USD), high-risk count."""
    n = F.count(F.lit(1))
    return view.agg(
        n.alias("accounts"),
        F.try_divide(F.sum("default_next_month").cast("double") * 100, n).alias("overall_default_rate"),
        (F.sum("credit_limit").cast("double") * F.lit(1.0 / fx_rate)).alias("total_exposure_usd"),
        F.count_if(F.col("risk_tier") == high).alias("high_risk_accounts"))


def label_distribution(outcomes: DataFrame, overall: str = "group_keys", digits: int | None = 2) -> DataFrame:
    """Accounts per label with a portfolio rate column.

    overall="group_keys": the rate is the average of the grouped label values
      (what an AVG window over a GROUP BY on the label yields: always 50 when
      both labels occur).
    overall="rows": the intended rate, defaults / accounts.
    Both are computed on the two-row grouped result.
    """
    g = outcomes.groupBy("default_next_month").agg(F.count(F.lit(1)).alias("account_count"))
    whole = Window.partitionBy()
    if overall == "group_keys":
        rate = F.avg("default_next_month").over(whole) * 100
    elif overall == "rows":
        rate = (F.sum(F.col("default_next_month") * F.col("account_count")).over(whole) * F.lit(100.0)
                / F.sum("account_count").over(whole))
    else:
        raise ValueError("overall must be 'group_keys' or 'rows'")
    return g.withColumn("portfolio_default_rate_pct", F.round(rate, digits) if digits is not None else rate)


def ordered(df: DataFrame, cols: list, category_order: dict[str, list[str]] | None = None) -> DataFrame:
    """Sort a (small, aggregated) result: ``cols`` are column names or sort
    Columns; a column named in ``category_order`` sorts by its position in
    the given list (e.g. Low, Medium, High) instead of alphabetically.
    Nulls go last, as in a SQL ascending sort."""
    category_order = category_order or {}
    keys = []
    for c in cols:
        if isinstance(c, str) and c in category_order:
            keys.append(tier_rank(c, category_order[c]).asc_nulls_last())
        elif isinstance(c, str):
            keys.append(F.col(c).asc_nulls_last())
        else:
            keys.append(c)
    return df.orderBy(*keys)
