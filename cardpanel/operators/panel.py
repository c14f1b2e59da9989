"""Reshaping between the wide account record and the monthly panel.

The wide record holds one row per account with six status / bill / payment
columns.  ``to_panel`` turns it into six rows per account with one
``inline(array(struct ...))`` - a Generate node over a single scan, no shuffle.
``to_wide`` goes back with six conditional aggregates in one ``groupBy``
(no pivot pass to discover values: months are fixed).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardpanel.schema import MONEY, MONTHS, STATUS_COLUMNS


def to_panel(wide: DataFrame, months: int = MONTHS, status_columns=STATUS_COLUMNS) -> DataFrame:
    """customer_id, month_number, bill_amount, pay_amount, payment_status.

    Month m reads bill_amt{m}, pay_amt{m} and the m-th status column (the
    status columns are named pay_0, pay_2 .. pay_6: there is no pay_1)."""
    rows = [F.struct(F.lit(m).alias("month_number"),
                     F.col(f"bill_amt{m}").cast(MONEY).alias("bill_amount"),
                     F.col(f"pay_amt{m}").cast(MONEY).alias("pay_amount"),
                     F.col(status_columns[m - 1]).cast("int").alias("payment_status"))
            for m in range(1, months + 1)]
    return wide.select(F.col("id").cast("long").alias("customer_id"), F.inline(F.array(*rows)))


def split_accounts(wide: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(customers, outcomes, panel) from the wide record: projections only."""
    customers = wide.select(F.col("id").cast("long").alias("customer_id"), F.col("limit_bal").cast(MONEY).alias("credit_limit"),
                            F.col("sex").cast("short").alias("sex"), F.col("education").cast("short").alias("education"),
                            F.col("marriage").cast("short").alias("marriage"), F.col("age").cast("int").alias("age"))
    outcomes = wide.select(F.col("id").cast("long").alias("customer_id"),
                           F.col("default_payment_next_month").cast("int").alias("default_next_month"))
    return customers, outcomes, to_panel(wide)


def to_wide(panel: DataFrame, customers: DataFrame, outcomes: DataFrame, months: int = MONTHS,
            status_columns=STATUS_COLUMNS) -> DataFrame:
    """The 25-column source record rebuilt from the three tables."""
    m = F.col("month_number")
    aggs = []
    for k in range(1, months + 1):
        aggs.append(F.max(F.when(m == k, F.col("payment_status"))).cast("short").alias(status_columns[k - 1]))
    for k in range(1, months + 1):
        aggs.append(F.max(F.when(m == k, F.col("bill_amount"))).alias(f"bill_amt{k}"))
    for k in range(1, months + 1):
        aggs.append(F.max(F.when(m == k, F.col("pay_amount"))).alias(f"pay_amt{k}"))
    per_account = panel.groupBy("customer_id").agg(*aggs)
    c = customers.select(F.col("customer_id"), F.col("credit_limit").alias("limit_bal"), "sex", "education",
                         "marriage", "age")
    j = c.join(per_account, "customer_id", "left").join(outcomes, "customer_id", "left")
    cols = (["limit_bal", "sex", "education", "marriage", "age"] + list(status_columns[:months])
            + [f"bill_amt{k}" for k in range(1, months + 1)] + [f"pay_amt{k}" for k in range(1, months + 1)])
    return j.select(F.col("customer_id").alias("id"), *cols,
                    F.col("default_next_month").cast("short").alias("default_payment_next_month"))


def with_panel_id(panel: DataFrame, months: int = MONTHS) -> DataFrame:
    """Deterministic surrogate key: customer_id * months + month_number.
    Stable across re-runs and partitionings (unlike monotonically_increasing_id)."""
    return panel.withColumn("id", F.col("customer_id") * months + F.col("month_number"))
