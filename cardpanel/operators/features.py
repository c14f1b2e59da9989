"""Behavioural features per account and the feature validation queries.

``credit_features`` computes all eight features in ONE aggregation keyed by
``customer_id``: the customers (anchor, so every account gets a row) are
left-joined to the statements, and the aggregation reuses the join's hash
partitioning - at most one shuffle of each input, none when both are stored
bucketed by customer_id (``plans.portfolio``).  Statements are unique per
(customer, month) and months are 1..6, so no group grows with the data; the
streak is a bit-mask fold (``bit_or``), not a collected list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardpanel.functions.columns import (composite_score, guarded_ratio, left_closed_bucket, on_time_bucket,
                                         safe_divide)
from cardpanel.schema import FEATURES, MONTHS

DOUBLE_FEATURES = ["avg_utilization", "utilization_trend", "payment_ratio", "balance_volatility"]
INT_FEATURES = [c for c in FEATURES if c not in DOUBLE_FEATURES]
# Reporting precision of the rounded feature table.
ROUND_DIGITS = {"avg_utilization": 4, "utilization_trend": 4, "payment_ratio": 4, "balance_volatility": 2}


def delay_mask(status="payment_status", month="month_number", months: int = MONTHS):
    """Aggregate: bit (m-1) set when month m is delayed (status >= 1)."""
    s, m = F.col(status), F.col(month)
    bit = F.when((s >= 1) & m.between(1, months), F.expr(f"shiftleft(1, `{month}` - 1)"))
    return F.coalesce(F.bit_or(bit), F.lit(0))


def longest_run(mask, months: int = MONTHS):
    """Length of the longest run of set bits in an integer of ``months`` bits.

    a_1 = mask, a_k = a_{k-1} & (mask >> (k-1)); a_k is non-zero iff some run
    has length >= k, so the longest run is the number of non-zero a_k.
    """
    total, a = None, mask
    for k in range(1, months + 1):
        if k > 1:
            a = a.bitwiseAND(F.shiftright(mask, k - 1))
        term = (a != 0).cast("int")
        total = term if total is None else total + term
    return total


def credit_features(panel: DataFrame, customers: DataFrame, semantics: str = "panel",
                    round_: bool | None = None, months: int = MONTHS) -> DataFrame:
    """Eight features per account.

    semantics="panel": SQL rules - utilization NULL for a zero limit and skipped
      by the average and slope; payment ratio averaged over months with a
      positive bill; features rounded 4/4/4/2 dp (``round_`` default True).
    semantics="wide": record rules - utilization 0 for a zero limit or a missing
      value, averages divide by ``months``; slope over all months; unrounded
      (``round_`` default False).
    """
    if semantics not in ("panel", "wide"):
        raise ValueError("semantics must be 'panel' or 'wide'")
    if round_ is None:
        round_ = semantics == "panel"
    base = customers.select("customer_id", "credit_limit").join(
        panel.select("customer_id", "month_number", "bill_amount", "pay_amount", "payment_status"),
        "customer_id", "left")
    bill = F.col("bill_amount").cast("double")
    pay = F.col("pay_amount").cast("double")
    limit = F.col("credit_limit").cast("double")
    x = F.col("month_number").cast("double")
    status = F.col("payment_status")

    if semantics == "wide":
        return _wide_features(base, months, round_)
    util = safe_divide(bill, limit)
    xu = F.when(util.isNotNull(), x)
    n, sx, sy = F.count(util), F.sum(xu), F.sum(util)
    sxy, sxx = F.sum(xu * util), F.sum(xu * xu)
    avg_util = F.avg(util)
    ratio = F.avg(F.when(bill > 0, safe_divide(pay, bill)))
    slope_den = n * sxx - sx * sx
    slope = (n * sxy - sx * sy) / F.when(slope_den != 0, slope_den)

    agg = base.groupBy("customer_id").agg(
        avg_util.alias("avg_utilization"),
        slope.alias("utilization_trend"),
        F.count_if(status <= 0).alias("on_time_months"),
        F.max(status).alias("max_delinquency"),
        (F.max(status) - F.min(status)).alias("delinquency_drift"),
        longest_run(delay_mask(months=months), months).alias("consecutive_delays"),
        ratio.alias("payment_ratio"),
        F.stddev_samp(bill).alias("balance_volatility"),
    )
    return _finish(agg, round_)


def _finish(agg: DataFrame, round_: bool) -> DataFrame:
    cols = [F.col("customer_id")]
    for c in FEATURES:
        if c in DOUBLE_FEATURES:
            v = F.coalesce(F.col(c).cast("double"), F.lit(0.0))
            if round_:
                v = F.round(v, ROUND_DIGITS[c])
        else:
            v = F.coalesce(F.col(c), F.lit(0)).cast("int")
        cols.append(v.alias(c))
    return agg.select(*cols)


def _in_order(cols):
    """Left-to-right sum in a fixed order (month 1 first): the result does not
    depend on the order rows reach the aggregation."""
    total = None
    for c in cols:
        total = c if total is None else total + c
    return total


def _wide_features(base: DataFrame, months: int, round_: bool) -> DataFrame:
    """Record rules over the six month slots of each account.

    The aggregation only places each month's value in its slot (one row per
    account and month); sums, the slope and the two-pass sample deviation are
    then computed across the slots in month order, so every engine and every
    partitioning gives bit-identical results."""
    bill = F.col("bill_amount").cast("double")
    pay = F.col("pay_amount").cast("double")
    limit = F.col("credit_limit").cast("double")
    m, status = F.col("month_number"), F.col("payment_status")
    util = F.when(limit != 0, bill / limit)
    ratio = guarded_ratio(pay, bill)
    slots = []
    for k in range(1, months + 1):
        in_k = m == k
        slots += [F.max(F.when(in_k, util)).alias(f"__u{k}"), F.max(F.when(in_k, ratio)).alias(f"__r{k}"),
                  F.max(F.when(in_k, bill)).alias(f"__b{k}")]
    agg = base.groupBy("customer_id").agg(
        *slots,
        F.count_if(status <= 0).alias("on_time_months"),
        F.max(status).alias("max_delinquency"),
        (F.max(status) - F.min(status)).alias("delinquency_drift"),
        longest_run(delay_mask(months=months), months).alias("consecutive_delays"))
    ks = range(1, months + 1)
    u = [F.coalesce(F.col(f"__u{k}"), F.lit(0.0)) for k in ks]
    r = [F.coalesce(F.col(f"__r{k}"), F.lit(0.0)) for k in ks]
    b = [F.col(f"__b{k}") for k in ks]
    n = float(months)
    sx, sxx = months * (months + 1) / 2.0, months * (months + 1) * (2 * months + 1) / 6.0
    su, sxu = _in_order(u), _in_order([F.lit(float(k)) * u[k - 1] for k in ks])
    nb = _in_order([F.when(bk.isNotNull(), F.lit(1)).otherwise(F.lit(0)) for bk in b])
    mean = F.when(nb > 0, _in_order([F.coalesce(bk, F.lit(0.0)) for bk in b]) / nb)
    ss = _in_order([F.when(bk.isNotNull(), (bk - mean) * (bk - mean)).otherwise(F.lit(0.0)) for bk in b])
    out = agg.select(
        "customer_id",
        (su / F.lit(n)).alias("avg_utilization"),
        ((F.lit(n) * sxu - F.lit(sx) * su) / F.lit(n * sxx - sx * sx)).alias("utilization_trend"),
        "on_time_months", "max_delinquency", "delinquency_drift", "consecutive_delays",
        (_in_order(r) / F.lit(n)).alias("payment_ratio"),
        F.when(nb > 1, F.sqrt(ss / (nb - 1))).alias("balance_volatility"))
    return _finish(out, round_)


def delayed_sequence(panel: DataFrame) -> DataFrame:
    """ROW_NUMBER of each delayed month (status >= 1) within its account."""
    w = Window.partitionBy("customer_id").orderBy("month_number")
    return (panel.filter(F.col("payment_status") >= 1)
            .select("customer_id", "month_number", F.row_number().over(w).alias("delayed_sequence")))


def longest_streak(panel: DataFrame) -> DataFrame:
    """Gaps-and-islands form of the streak feature: island key = month - row
    number; count per island, then max per account.  Both groupings share the
    ``customer_id`` prefix, so the window's shuffle serves all of them."""
    d = delayed_sequence(panel).withColumn("island_key", F.col("month_number") - F.col("delayed_sequence"))
    per_island = d.groupBy("customer_id", "island_key").agg(F.count(F.lit(1)).alias("streak_length"))
    return per_island.groupBy("customer_id").agg(F.max("streak_length").cast("int").alias("consecutive_delays"))


def melt_features(features: DataFrame, names=FEATURES) -> DataFrame:
    """(customer_id, feature_name, feature_value): one scan, an Expand node."""
    return features.select("customer_id", *[F.col(c).cast("double").alias(c) for c in names]).unpivot(
        "customer_id", list(names), "feature_name", "feature_value")


def feature_correlations(features: DataFrame, names=FEATURES, digits: int | None = 4) -> DataFrame:
    """All unordered feature pairs (a < b by name) in ONE aggregation pass -
    28 covariances and 8 standard deviations, each computed once - unpivoted
    to (feature_a, feature_b, correlation).  A constant feature gives NULL."""
    pairs = sorted((a, b) for a in names for b in names if a < b)
    d = features.select(*[F.col(c).cast("double").alias(c) for c in names])
    wide = d.agg(*[F.covar_pop(a, b).alias(f"{a}|{b}") for a, b in pairs],
                 *[F.stddev_pop(c).alias(f"sd|{c}") for c in names])

    def corr(a, b):
        den = F.col(f"`sd|{a}`") * F.col(f"`sd|{b}`")
        return F.col(f"`{a}|{b}`") / F.when(den != 0, den)
    stacked = wide.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), corr(a, b).alias("correlation"))
        for a, b in pairs])).alias("p")).select("p.*")
    if digits is not None:
        stacked = stacked.withColumn("correlation", F.round("correlation", digits))
    return stacked


def feature_correlations_long(features: DataFrame, names=FEATURES, digits: int | None = 4) -> DataFrame:
    """Self-join form: melted features joined on account with a.name < b.name,
    then a correlation per pair.  Kept as a cross-check of the direct form."""
    m = melt_features(features, names)
    a = m.select("customer_id", F.col("feature_name").alias("feature_a"), F.col("feature_value").alias("va"))
    b = m.select("customer_id", F.col("feature_name").alias("feature_b"), F.col("feature_value").alias("vb"))
    j = a.join(b, "customer_id").filter(F.col("feature_a") < F.col("feature_b"))
    den = F.stddev_pop("va") * F.stddev_pop("vb")
    out = j.groupBy("feature_a", "feature_b").agg((F.covar_pop("va", "vb") / F.when(den != 0, den)).alias("correlation"))
    if digits is not None:
        out = out.withColumn("correlation", F.round("correlation", digits))
    return out


def correlation_matrix(features: DataFrame, names=FEATURES, digits: int | None = None) -> DataFrame:
    """Square matrix for a heatmap: one row per feature, one column per
    feature, 1.0 on the diagonal.  Built from the one-pass pair correlations:
    8 rows whatever the data size."""
    long = feature_correlations(features, names, digits=digits)
    sym = long.unionByName(long.select(F.col("feature_b").alias("feature_a"), F.col("feature_a").alias("feature_b"),
                                       "correlation"))
    cells = [F.max(F.when(F.col("feature_b") == n, F.col("correlation"))).alias(n) for n in names]
    m = sym.groupBy("feature_a").agg(*cells)
    return m.select("feature_a", *[F.when(F.col("feature_a") == n, F.lit(1.0)).otherwise(F.col(n)).alias(n)
                                   for n in names])


def with_outcome(features: DataFrame, outcomes: DataFrame) -> DataFrame:
    return features.join(outcomes, "customer_id")


def _rate_table(df: DataFrame, key, key_name: str, digits: int | None) -> DataFrame:
    rate = F.avg(F.col("default_next_month")) * 100
    if digits is not None:
        rate = F.round(rate, digits)
    return (df.groupBy(key.alias(key_name))
            .agg(F.count(F.lit(1)).alias("account_count"), rate.alias("default_rate_pct")))


def utilization_buckets(features: DataFrame, outcomes: DataFrame, digits: int | None = 2) -> DataFrame:
    """10% utilization buckets (left-closed, 0 below, 11 at/above 100%)."""
    return _rate_table(with_outcome(features, outcomes), left_closed_bucket("avg_utilization", 0, 1, 10),
                       "utilization_bucket", digits)


def on_time_buckets(features: DataFrame, outcomes: DataFrame, digits: int | None = 2) -> DataFrame:
    return _rate_table(with_outcome(features, outcomes), on_time_bucket(), "on_time_month_bucket", digits)


def delinquency_levels(features: DataFrame, outcomes: DataFrame, digits: int | None = 2) -> DataFrame:
    return _rate_table(with_outcome(features, outcomes), F.col("max_delinquency"), "max_delinquency", digits)


def riskiest(features: DataFrame, n: int = 10) -> DataFrame:
    """Top n accounts by the composite heuristic; ties broken by customer_id
    (TakeOrderedAndProject: a per-partition top-n, no global sort)."""
    return (features.select("customer_id", composite_score().alias("composite_risk_score"),
                            "avg_utilization", "max_delinquency", "delinquency_drift")
            .orderBy(F.col("composite_risk_score").desc_nulls_last(), F.col("customer_id").asc())
            .limit(n))


def clean_features(df: DataFrame, names=FEATURES) -> DataFrame:
    """inf / NaN / NULL -> 0 in the feature columns (model input hygiene)."""
    out = df
    for c in names:
        v = F.col(c).cast("double")
        bad = v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf")))
        out = out.withColumn(c, F.when(bad, F.lit(0.0)).otherwise(v))
    return out
