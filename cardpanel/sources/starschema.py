"""Portfolio tables derived from the TPC-H-like star schema.

The test tables hold no card portfolio, so accounts, monthly statements and
outcomes are derived from ``customer`` / ``orders`` / ``lineitem`` with integer
and exact-decimal arithmetic only (the same rules are written as SQL in
``cardpanel.plans.oracle``):

* customers: one per ``c_custkey``; limit = max(acctbal, 0) x 100.
* statements: every customer x month 1..6, month = month(o_orderdate) % 6 + 1;
  bill = signed sum of order totals, payment = returned line value, status from
  order priorities (-2 when the account had no order that month).
* outcomes: from month 1 status and the key.

Plan shape: lineitem is pre-aggregated per order (partial aggregation absorbs a
hot order), joined 1:1 to orders, then aggregated per customer with one
conditional sum per month (partial aggregation absorbs a hot customer); the
six months are exploded from that row, so the panel leaves the build already
hash-partitioned by customer_id.  No broadcast of anything that grows with
the data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardpanel.schema import MONEY, MONTHS


@dataclass
class Portfolio:
    customers: DataFrame
    panel: DataFrame
    outcomes: DataFrame


def read_tables(spark: SparkSession, sf_dir: str, names=("customer", "orders", "lineitem")) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}


def customers_from_star(customer: DataFrame) -> DataFrame:
    key = F.col("c_custkey")
    limit = F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).otherwise(F.lit(0.0)).cast(MONEY)
    return customer.select(
        key.alias("customer_id"),
        (limit * 100).cast(MONEY).alias("credit_limit"),
        (1 + key % 2).cast("short").alias("sex"),
        (key % 7).cast("short").alias("education"),
        (F.col("c_nationkey") % 4).cast("short").alias("marriage"),
        (21 + key % 55).cast("int").alias("age"),
    )


def cents(amount) -> "F.Column":
    """Exact money in integer cents: decimal(12,2) x 100 as a long.  Sums of
    longs stay in compact, code-generated aggregation buffers; wide decimal
    sums (precision > 18) would be held as big decimals."""
    return (amount.cast(MONEY) * 100).cast("long")


def from_cents(c) -> "F.Column":
    return (c.cast("decimal(20,0)") / F.lit(100)).cast(MONEY)


def _orders_with_returns(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    returned = (
        lineitem.filter(F.col("l_returnflag") == "R")
        .groupBy("l_orderkey")
        .agg(F.sum(cents(F.col("l_extendedprice"))).alias("order_pay"))
    )
    okey = F.col("o_orderkey")
    price = cents(F.col("o_totalprice"))
    signed = F.when((F.col("o_orderstatus") == "F") & (okey % 5 == 0), -price).otherwise(price)
    urgent = F.when(F.col("o_orderpriority") == "1-URGENT", 1 + okey % 3).otherwise(F.lit(0))
    o = orders.select(
        "o_orderkey", F.col("o_custkey").alias("customer_id"),
        (F.month("o_orderdate") % 6 + 1).alias("month_number"),
        signed.alias("signed_total"), urgent.alias("urgency"),
        (F.col("o_orderpriority") == "5-LOW").alias("is_low"),
    )
    return o.join(returned, o["o_orderkey"] == returned["l_orderkey"], "left")


def monthly_aggregates(orders: DataFrame, lineitem: DataFrame, months: int = MONTHS) -> DataFrame:
    """One row per customer with orders: bill_m, pay_m, u_m, lo_m, n_m for
    each month m - month-conditional sums in ONE aggregation keyed by the
    customer, so the result is hash-partitioned by customer_id (the key of
    every later join and aggregation)."""
    j = _orders_with_returns(orders, lineitem)
    aggs = []
    for m in range(1, months + 1):
        in_m = F.col("month_number") == m
        aggs += [F.sum(F.when(in_m, F.col("signed_total"))).alias(f"bill_{m}"),
                 F.sum(F.when(in_m, F.col("order_pay"))).alias(f"pay_{m}"),
                 F.sum(F.when(in_m, F.col("urgency"))).alias(f"u_{m}"),
                 F.count_if(in_m & F.col("is_low")).alias(f"lo_{m}"),
                 F.count_if(in_m).alias(f"n_{m}")]
    return j.groupBy("customer_id").agg(*aggs)


def status_rule(has_order, u, lo):
    return (
        F.when(~has_order, F.lit(-2))
        .when(u > 9, F.lit(9))
        .when(u > 0, u)
        .when(lo > 0, F.lit(-1))
        .otherwise(F.lit(0))
        .cast("int")
    )


def panel_from_star(customers: DataFrame, orders: DataFrame, lineitem: DataFrame, months: int = MONTHS) -> DataFrame:
    """Every customer x month 1..6: the per-customer aggregate is left-joined
    to the customers and its six months are exploded in place (a narrow
    ``inline``), so the panel keeps the customer_id partitioning."""
    agg = monthly_aggregates(orders, lineitem, months)
    j = customers.select("customer_id").join(agg, "customer_id", "left")
    rows = []
    for m in range(1, months + 1):
        has_order = F.coalesce(F.col(f"n_{m}"), F.lit(0)) > 0
        rows.append(F.struct(
            F.lit(m).alias("month_number"),
            from_cents(F.coalesce(F.col(f"bill_{m}"), F.lit(0))).alias("bill_amount"),
            from_cents(F.coalesce(F.col(f"pay_{m}"), F.lit(0))).alias("pay_amount"),
            status_rule(has_order, F.col(f"u_{m}"), F.col(f"lo_{m}")).alias("payment_status")))
    return j.select("customer_id", F.inline(F.array(*rows)))


def outcomes_from_panel(panel: DataFrame) -> DataFrame:
    key = F.col("customer_id")
    default = ((F.col("payment_status") >= 2) & (key % 3 != 0)) | (key % 7 == 0)
    return panel.filter(F.col("month_number") == 1).select(
        "customer_id", default.cast("int").alias("default_next_month"))


def star_portfolio(spark: SparkSession, sf_dir: str) -> Portfolio:
    t = read_tables(spark, sf_dir)
    customers = customers_from_star(t["customer"])
    panel = panel_from_star(customers, t["orders"], t["lineitem"])
    return Portfolio(customers, panel, outcomes_from_panel(panel))


def sparse_panel(panel: DataFrame) -> DataFrame:
    """Drop months without any activity (status -2): a panel with real gaps."""
    return panel.filter(F.col("payment_status") != -2)
