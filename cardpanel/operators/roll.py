"""Delinquency buckets, month-to-month transitions and roll-rate matrices.

Transitions use ``lead`` over a window partitioned by ``customer_id`` and
ordered by month: one shuffle on the account key, at most six rows per
window partition (statements are unique per account and month).  The
self-join form is kept as a cross-check.  Counting collapses everything to at
most (pairs x 5 x 5) rows before the percentage window runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardpanel.functions.columns import CURRENT, DPD30, DPD60, delinquency_bucket
from cardpanel.schema import BUCKETS, MONTHS


def bucketed(panel: DataFrame, chronological: bool = False, null_as_worst: bool = False,
             months: int = MONTHS) -> DataFrame:
    """customer_id, month_number, payment_status, delinquency_bucket.

    ``chronological`` renumbers months so 1 is the EARLIEST statement (the
    source numbers them newest first)."""
    m = F.col("month_number")
    month = (F.lit(months + 1) - m) if chronological else m
    return panel.select("customer_id", month.cast("int").alias("month_number"), "payment_status",
                        delinquency_bucket("payment_status", null_as_worst).alias("delinquency_bucket"))


def transitions(panel: DataFrame, chronological: bool = False, form: str = "lead",
                null_as_worst: bool = False) -> DataFrame:
    """customer_id, from_month, to_month, from_bucket, to_bucket for every
    account with statements in consecutive months m and m+1."""
    b = bucketed(panel, chronological, null_as_worst)
    if form == "lead":
        w = Window.partitionBy("customer_id").orderBy("month_number")
        t = b.select("customer_id", F.col("month_number").alias("from_month"),
                     F.col("delinquency_bucket").alias("from_bucket"),
                     F.lead("month_number").over(w).alias("to_month"),
                     F.lead("delinquency_bucket").over(w).alias("to_bucket"))
        return t.filter(F.col("to_month") == F.col("from_month") + 1)
    if form == "join":
        a = b.select("customer_id", F.col("month_number").alias("from_month"),
                     F.col("delinquency_bucket").alias("from_bucket"))
        c = b.select(F.col("customer_id").alias("cid"), F.col("month_number").alias("to_month"),
                     F.col("delinquency_bucket").alias("to_bucket"))
        j = a.join(c, (a["customer_id"] == c["cid"]) & (c["to_month"] == a["from_month"] + 1))
        return j.select("customer_id", "from_month", "to_month", "from_bucket", "to_bucket")
    raise ValueError("form must be 'lead' or 'join'")


def pct_within(df: DataFrame, n_col: str, keys: list[str], out: str, digits: int | None = None) -> DataFrame:
    """n / sum(n) over the given keys, on an already aggregated frame."""
    share = F.col(n_col) * F.lit(100.0) / F.sum(n_col).over(Window.partitionBy(*keys))
    return df.withColumn(out, F.round(share, digits) if digits is not None else share)


def roll_rates(panel: DataFrame, round_dp: int | None = None, chronological: bool = False,
               form: str = "lead", null_as_worst: bool = False) -> DataFrame:
    """month_pair, from_bucket, to_bucket, account_count, pct_of_accounts.

    pct is within (month pair, from bucket); ``round_dp=2`` gives the SQL
    report, ``None`` the unrounded export."""
    t = transitions(panel, chronological, form, null_as_worst)
    counts = t.groupBy("from_month", "to_month", "from_bucket", "to_bucket").agg(
        F.count(F.lit(1)).alias("account_count"))
    counts = pct_within(counts, "account_count", ["from_month", "from_bucket"], "pct_of_accounts", round_dp)
    return counts.select(
        F.concat(F.col("from_month").cast("string"), F.lit("->"), F.col("to_month").cast("string")).alias("month_pair"),
        "from_bucket", "to_bucket", "account_count", "pct_of_accounts")


def forward_roll(panel: DataFrame, outcomes: DataFrame, digits: int | None = None, month: int = 1) -> DataFrame:
    """Default rate by the bucket each account is in at ``month``."""
    b = bucketed(panel).filter(F.col("month_number") == month)
    j = b.join(outcomes, "customer_id")
    rate = F.avg("default_next_month") * 100
    return j.groupBy(F.col("delinquency_bucket").alias("month_1_bucket")).agg(
        F.count(F.lit(1)).alias("account_count"),
        (F.round(rate, digits) if digits is not None else rate).alias("default_rate_pct"))


def roll_matrix_pivot(roll: DataFrame, buckets=BUCKETS) -> DataFrame:
    """Rows (month_pair, from_bucket), one column per to-bucket (fixed list,
    so the pivot needs no extra pass to find its values)."""
    return roll.groupBy("month_pair", "from_bucket").pivot("to_bucket", list(buckets)).agg(F.first("pct_of_accounts"))


def roll_cell(roll: DataFrame, pair: str, from_bucket: str, to_bucket: str, name: str = "pct") -> DataFrame:
    """One cell of the matrix; 0 when that transition never occurred."""
    f = roll.filter((F.col("month_pair") == pair) & (F.col("from_bucket") == from_bucket)
                    & (F.col("to_bucket") == to_bucket))
    return f.agg(F.coalesce(F.max("pct_of_accounts"), F.lit(0.0)).alias(name))


def roll_summary(roll: DataFrame, pair: str = "1->2") -> DataFrame:
    """Stay-current, cure and roll-forward rates of one month pair, one row."""
    r = roll.filter(F.col("month_pair") == pair)

    def cell(fb, tb):
        return F.coalesce(F.max(F.when((F.col("from_bucket") == fb) & (F.col("to_bucket") == tb),
                                       F.col("pct_of_accounts"))), F.lit(0.0))
    return r.agg(cell(CURRENT, CURRENT).alias("current_stay_pct"),
                 cell(DPD30, CURRENT).alias("cure_30_pct"),
                 cell(DPD30, DPD60).alias("roll_30_to_60_pct")).select(
        F.lit(pair).alias("month_pair"), "*")
