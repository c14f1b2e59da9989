"""Registered queries: data quality, reshaping, upsert."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardpanel.operators import panel as pn
from cardpanel.operators import quality as qa
from cardpanel.operators.features import credit_features
from cardpanel.plans.catalog import FEATURE_SELECT, _plan, register
from cardpanel.schema import CUSTOMER_RULES, CUSTOMERS_SCHEMA, OUTCOME_RULES, PANEL_RULES, TIER_HIGH, TIER_RULES
from cardpanel.sources.starschema import sparse_panel
from cardpanel.sources.upsert import upsert

RULE_SETS = [("customers", CUSTOMER_RULES), ("monthly_payments", PANEL_RULES), ("outcomes", OUTCOME_RULES),
             ("risk_tiers", TIER_RULES)]


def _rules_sql() -> str:
    parts = []
    for table, rules in RULE_SETS:
        for r in rules:
            name = r.name.replace("'", "''")
            parts.append(f"SELECT '{r.table}' AS table_name, '{name}' AS rule, "
                         f"COUNT(*) FILTER (WHERE NOT ({qa.rule_sql(r, chr(34))})) AS violations FROM {table}")
    return "\nUNION ALL\n".join(parts)


def _tables(p):
    return {"customers": p.customers, "monthly_payments": p.panel, "outcomes": p.outcomes, "risk_tiers": p.tiers}


@register("check_rules", _rules_sql(), group="quality")
def q_check_rules(spark, sf_dir):
    p = _plan(spark, sf_dir)
    t = _tables(p)
    out = None
    for table, rules in RULE_SETS:
        c = qa.check(t[table], rules)
        out = c if out is None else out.unionByName(c)
    return out


def _enforce_sql() -> str:
    parts = []
    for table, rules in RULE_SETS:
        bad = " OR ".join(f"COALESCE(NOT ({qa.rule_sql(r, chr(34))}), FALSE)" for r in rules)
        parts.append(f"SELECT '{table}' AS table_name, COUNT(*) FILTER (WHERE NOT ({bad})) AS good_rows, "
                     f"COUNT(*) FILTER (WHERE {bad}) AS rejected_rows FROM {table}")
    return "\nUNION ALL\n".join(parts)


@register("enforce_summary", _enforce_sql(), group="quality")
def q_enforce_summary(spark, sf_dir):
    p = _plan(spark, sf_dir)
    t = _tables(p)
    out = None
    for table, rules in RULE_SETS:
        c = qa.enforce_summary(t[table], rules, table)
        out = c if out is None else out.unionByName(c)
    return out


KEYS = [("customers", ["customer_id"]), ("monthly_payments", ["customer_id", "month_number"]),
        ("outcomes", ["customer_id"]), ("credit_features", ["customer_id"]), ("risk_tiers", ["customer_id"])]


def _dup_sql() -> str:
    parts = []
    for table, keys in KEYS:
        k = ", ".join(keys)
        parts.append(f"SELECT '{table}' AS table_name, '{k}' AS key_columns, "
                     f"COUNT(*) FILTER (WHERE n > 1) AS duplicate_keys, "
                     f"CAST(COALESCE(SUM(CASE WHEN n > 1 THEN n - 1 END), 0) AS BIGINT) AS excess_rows "
                     f"FROM (SELECT {k}, COUNT(*) AS n FROM {table} GROUP BY {k}) d")
    return "\nUNION ALL\n".join(parts)


@register("duplicate_keys", _dup_sql(), group="quality")
def q_duplicate_keys(spark, sf_dir):
    p = _plan(spark, sf_dir)
    t = {"customers": p.customers, "monthly_payments": p.panel, "outcomes": p.outcomes,
         "credit_features": p.features, "risk_tiers": p.tiers}
    out = None
    for table, keys in KEYS:
        c = qa.duplicate_summary(t[table], keys, table)
        out = c if out is None else out.unionByName(c)
    return out


ORPHAN_TABLES = ["monthly_payments", "outcomes", "credit_features", "risk_tiers"]


@register("orphan_rows", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS orphan_rows FROM {t} x "
    f"WHERE NOT EXISTS (SELECT 1 FROM customers c WHERE c.customer_id = x.customer_id)" for t in ORPHAN_TABLES),
    group="quality")
def q_orphan_rows(spark, sf_dir):
    p = _plan(spark, sf_dir)
    t = {"monthly_payments": p.panel, "outcomes": p.outcomes, "credit_features": p.features, "risk_tiers": p.tiers}
    out = None
    for name in ORPHAN_TABLES:
        c = qa.orphan_summary(t[name], p.customers, "customer_id", name)
        out = c if out is None else out.unionByName(c)
    return out


COUNTED = ["customers", "monthly_payments", "outcomes"]


@register("row_counts", " UNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS rows_loaded FROM {t}" for t in COUNTED), group="quality")
def q_row_counts(spark, sf_dir):
    p = _plan(spark, sf_dir)
    return qa.row_counts({"customers": p.customers, "monthly_payments": p.panel, "outcomes": p.outcomes})


@register("null_profile", "SELECT " + ", ".join(f"COUNT(*) - COUNT({c}) AS {c}_nulls" for c in CUSTOMERS_SCHEMA.fieldNames()) + " FROM customers", group="quality")
def q_null_profile(spark, sf_dir):
    return qa.null_profile(_plan(spark, sf_dir).customers)


@register("coded_zero_counts", "SELECT " + ", ".join(
    f"COUNT(*) FILTER ({c} = 0) AS {c}_zero_records" for c in ("education", "marriage")) + " FROM customers", group="quality")
def q_coded_zero_counts(spark, sf_dir):
    return qa.coded_zero_counts(_plan(spark, sf_dir).customers)


@register("value_shares", """
SELECT default_next_month, COUNT(*) AS n, COUNT(*) / (SELECT CAST(COUNT(*) AS DOUBLE) FROM outcomes) AS share
FROM outcomes GROUP BY default_next_month""", group="quality")
def q_value_shares(spark, sf_dir):
    return qa.value_shares(_plan(spark, sf_dir).outcomes, "default_next_month")


@register("with_panel_id", """
SELECT customer_id, month_number, CAST(bill_amount AS DOUBLE) AS bill_amount, CAST(pay_amount AS DOUBLE) AS pay_amount,
       payment_status, customer_id * 6 + month_number AS id
FROM monthly_payments""", group="quality")
def q_with_panel_id(spark, sf_dir):
    p = _plan(spark, sf_dir)
    return pn.with_panel_id(p.panel).withColumn("bill_amount", F.col("bill_amount").cast("double")) \
        .withColumn("pay_amount", F.col("pay_amount").cast("double"))


WIDE_SQL = """
wide AS (
  SELECT c.customer_id AS id, CAST(c.credit_limit AS DOUBLE) AS limit_bal, c.sex, c.education, c.marriage, c.age,
         MAX(CASE WHEN mp.month_number = 1 THEN mp.payment_status END) AS pay_0,
         MAX(CASE WHEN mp.month_number = 2 THEN mp.payment_status END) AS pay_2,
         MAX(CASE WHEN mp.month_number = 3 THEN mp.payment_status END) AS pay_3,
         MAX(CASE WHEN mp.month_number = 4 THEN mp.payment_status END) AS pay_4,
         MAX(CASE WHEN mp.month_number = 5 THEN mp.payment_status END) AS pay_5,
         MAX(CASE WHEN mp.month_number = 6 THEN mp.payment_status END) AS pay_6,
         CAST(MAX(CASE WHEN mp.month_number = 1 THEN mp.bill_amount END) AS DOUBLE) AS bill_amt1,
         CAST(MAX(CASE WHEN mp.month_number = 2 THEN mp.bill_amount END) AS DOUBLE) AS bill_amt2,
         CAST(MAX(CASE WHEN mp.month_number = 3 THEN mp.bill_amount END) AS DOUBLE) AS bill_amt3,
         CAST(MAX(CASE WHEN mp.month_number = 4 THEN mp.bill_amount END) AS DOUBLE) AS bill_amt4,
         CAST(MAX(CASE WHEN mp.month_number = 5 THEN mp.bill_amount END) AS DOUBLE) AS bill_amt5,
         CAST(MAX(CASE WHEN mp.month_number = 6 THEN mp.bill_amount END) AS DOUBLE) AS bill_amt6,
         CAST(MAX(CASE WHEN mp.month_number = 1 THEN mp.pay_amount END) AS DOUBLE) AS pay_amt1,
         CAST(MAX(CASE WHEN mp.month_number = 2 THEN mp.pay_amount END) AS DOUBLE) AS pay_amt2,
         CAST(MAX(CASE WHEN mp.month_number = 3 THEN mp.pay_amount END) AS DOUBLE) AS pay_amt3,
         CAST(MAX(CASE WHEN mp.month_number = 4 THEN mp.pay_amount END) AS DOUBLE) AS pay_amt4,
         CAST(MAX(CASE WHEN mp.month_number = 5 THEN mp.pay_amount END) AS DOUBLE) AS pay_amt5,
         CAST(MAX(CASE WHEN mp.month_number = 6 THEN mp.pay_amount END) AS DOUBLE) AS pay_amt6,
         MAX(o.default_next_month) AS default_payment_next_month
  FROM customers c LEFT JOIN monthly_payments mp ON mp.customer_id = c.customer_id
  LEFT JOIN outcomes o ON o.customer_id = c.customer_id
  GROUP BY c.customer_id, c.credit_limit, c.sex, c.education, c.marriage, c.age
)
"""


def _wide(spark, sf_dir):
    p = _plan(spark, sf_dir)
    return pn.to_wide(p.panel, p.customers, p.outcomes)


def _money_to_double(df):
    return df.select(*[F.col(c).cast("double").alias(c) if t.startswith("decimal") else F.col(c)
                       for c, t in df.dtypes])


def _small_ints(df):
    return df.select(*[F.col(c).cast("int").alias(c) if t == "smallint" else F.col(c) for c, t in df.dtypes])


@register("to_wide", """
SELECT id, limit_bal, CAST(sex AS INTEGER) AS sex, CAST(education AS INTEGER) AS education,
       CAST(marriage AS INTEGER) AS marriage, age, pay_0, pay_2, pay_3, pay_4, pay_5, pay_6,
       bill_amt1, bill_amt2, bill_amt3, bill_amt4, bill_amt5, bill_amt6,
       pay_amt1, pay_amt2, pay_amt3, pay_amt4, pay_amt5, pay_amt6, default_payment_next_month
FROM wide""", WIDE_SQL, group="reshape")
def q_to_wide(spark, sf_dir):
    return _small_ints(_money_to_double(_wide(spark, sf_dir)))


@register("to_panel", """
SELECT customer_id, month_number, CAST(bill_amount AS DOUBLE) AS bill_amount, CAST(pay_amount AS DOUBLE) AS pay_amount,
       payment_status FROM monthly_payments""", group="reshape")
def q_to_panel(spark, sf_dir):
    """Round trip: panel -> wide record -> panel."""
    return _money_to_double(pn.to_panel(_wide(spark, sf_dir)))


@register("split_accounts", """
SELECT customer_id, CAST(credit_limit AS DOUBLE) AS credit_limit, CAST(sex AS INTEGER) AS sex,
       CAST(education AS INTEGER) AS education, CAST(marriage AS INTEGER) AS marriage, age
FROM customers""", group="reshape")
def q_split_accounts(spark, sf_dir):
    customers, _, _ = pn.split_accounts(_wide(spark, sf_dir))
    return _small_ints(_money_to_double(customers))


@register("credit_features_sparse", f"SELECT {FEATURE_SELECT} FROM sparse_features", """
line AS (
  SELECT customer_id, CAST(month_number AS DOUBLE) AS m, payment_status AS st, CAST(bill_amount AS DOUBLE) AS bill, CAST(pay_amount AS DOUBLE) AS pay,
         CAST(bill_amount AS DOUBLE) / NULLIF(CAST(credit_limit AS DOUBLE), 0) AS used, payment_status > -2 AS active
  FROM monthly_payments JOIN customers USING (customer_id)
),
sparse_features AS (
  -- a month of an inactive account ends a run as a paid one does: one letter per month, the longest run of L
  SELECT customer_id, ROUND(COALESCE(AVG(used) FILTER (active), 0), 4) AS avg_utilization,
         ROUND(CASE WHEN COUNT(used) FILTER (active) > 1 THEN REGR_SLOPE(used, m) FILTER (active) ELSE 0 END, 4) AS utilization_trend,
         CAST(COUNT(*) FILTER (active AND st <= 0) AS INTEGER) AS on_time_months,
         CAST(COALESCE(MAX(st) FILTER (active), 0) AS INTEGER) AS max_delinquency,
         CAST(COALESCE(MAX(st) FILTER (active) - MIN(st) FILTER (active), 0) AS INTEGER) AS delinquency_drift,
         CAST(LIST_MAX(LIST_TRANSFORM(STRING_SPLIT(STRING_AGG(CASE WHEN st >= 1 THEN 'L' ELSE '.' END, '' ORDER BY m), '.'), lambda run: LENGTH(run))) AS INTEGER)
           AS consecutive_delays,
         ROUND(COALESCE(AVG(pay / bill) FILTER (active AND bill > 0), 0), 4) AS payment_ratio,
         ROUND(COALESCE(STDDEV_SAMP(bill) FILTER (active), 0), 2) AS balance_volatility
  FROM line GROUP BY customer_id
)""", group="features")
def q_credit_features_sparse(spark, sf_dir):
    """Features on a panel with real gaps (inactive months dropped): streaks
    must break at a missing month."""
    p = _plan(spark, sf_dir)
    return credit_features(sparse_panel(p.panel), p.customers)


@register("upsert_panel", """
SELECT customer_id, month_number, CAST(bill_amount AS DOUBLE) AS bill_amount, CAST(pay_amount AS DOUBLE) AS pay_amount,
       payment_status FROM monthly_payments""", group="upsert")
def q_upsert_panel(spark, sf_dir):
    """Insert path: the sparse panel (active months only) upserted with the
    full six-month load gains the inactive months and keeps the rest."""
    p = _plan(spark, sf_dir)
    out = upsert(sparse_panel(p.panel), p.panel, ["customer_id", "month_number"],
                 ["bill_amount", "pay_amount", "payment_status"])
    return _money_to_double(out)


@register("upsert_limits", f"""
SELECT c.customer_id,
       CAST(CASE WHEN r.customer_id IS NOT NULL THEN CAST(c.credit_limit / 2 AS DECIMAL(12,2)) ELSE c.credit_limit END
            AS DOUBLE) AS credit_limit,
       CAST(c.sex AS INTEGER) AS sex, CAST(c.education AS INTEGER) AS education, CAST(c.marriage AS INTEGER) AS marriage,
       c.age
FROM customers c LEFT JOIN (SELECT customer_id FROM risk_tiers WHERE risk_tier = '{TIER_HIGH}') r USING (customer_id)""",
          group="upsert")
def q_upsert_limits(spark, sf_dir):
    """Update path: a limit review halves the limits of High Risk accounts;
    only credit_limit is in the update list, other columns keep the target."""
    p = _plan(spark, sf_dir)
    review = (p.tiers.filter(F.col("risk_tier") == TIER_HIGH).join(p.customers, "customer_id")
              .select("customer_id", (F.col("credit_limit") / 2).cast("decimal(12,2)").alias("credit_limit")))
    out = upsert(p.customers, review, ["customer_id"], ["credit_limit"])
    return _small_ints(_money_to_double(out))


# ------------------------------------------------- rows that break the rules
# The derived portfolio satisfies every rule, so the same queries also run on a
# copy of it that is broken by arithmetic on the account key: nulls, values out of
# range or domain, repeated keys, and rows without a customer.


def _broken(p):
    key = F.col("customer_id")
    own = p.customers.select(
        "customer_id", F.when(key % 11 == 0, None).when(key % 13 == 0, -F.col("credit_limit") - 1).otherwise(F.col("credit_limit"))
        .cast("decimal(12,2)").alias("credit_limit"),
        F.when(key % 17 == 0, 3).otherwise(F.col("sex")).alias("sex"), F.when(key % 19 == 0, 9).otherwise(F.col("education")).alias("education"),
        F.when(key % 7 == 3, None).otherwise(F.col("marriage")).alias("marriage"), F.when(key % 23 == 0, 17).otherwise(F.col("age")).alias("age"))
    customers = own.union(own.filter(key % 29 == 0)).union(own.filter(key % 58 == 0))
    panel = p.panel.select(
        F.when((key % 31 == 0) & (F.col("month_number") == 6), -key).otherwise(key).alias("customer_id"),
        F.when((key % 37 == 0) & (F.col("month_number") == 6), 7).otherwise(F.col("month_number")).alias("month_number"), "bill_amount", "pay_amount",
        F.when(key % 41 == 0, 10).otherwise(F.col("payment_status")).alias("payment_status"))
    outcomes = p.outcomes.select("customer_id", F.when(key % 43 == 0, 2).when(key % 47 == 0, None).otherwise(F.col("default_next_month"))
                                 .alias("default_next_month"))
    return {"customers": customers, "monthly_payments": panel, "outcomes": outcomes}


BROKEN_SQL = """
own AS (
  SELECT customer_id, CASE WHEN customer_id % 11 = 0 THEN NULL WHEN customer_id % 13 = 0 THEN -credit_limit - 1 ELSE credit_limit END AS credit_limit,
         CASE WHEN customer_id % 17 = 0 THEN 3 ELSE sex END AS sex, CASE WHEN customer_id % 19 = 0 THEN 9 ELSE education END AS education,
         CASE WHEN customer_id % 7 <> 3 THEN marriage END AS marriage, CASE WHEN customer_id % 23 = 0 THEN 17 ELSE age END AS age
  FROM customers
),
b_customers AS (
  SELECT * FROM own UNION ALL SELECT * FROM own WHERE customer_id % 29 = 0 UNION ALL SELECT * FROM own WHERE customer_id % 58 = 0
),
b_payments AS (
  SELECT CASE WHEN customer_id % 31 = 0 AND month_number = 6 THEN -customer_id ELSE customer_id END AS customer_id,
         CASE WHEN customer_id % 37 = 0 AND month_number = 6 THEN 7 ELSE month_number END AS month_number,
         CASE WHEN customer_id % 41 = 0 THEN 10 ELSE payment_status END AS payment_status
  FROM monthly_payments
),
b_outcomes AS (
  SELECT customer_id, CASE WHEN customer_id % 43 = 0 THEN 2 WHEN customer_id % 47 <> 0 THEN default_next_month END AS default_next_month FROM outcomes
)
"""
# Predicates of broken rows, written from the rule definitions.
BROKEN_RULES = [
    ("customers", "b_customers", "customers.customer_id not null", "customer_id IS NULL"),
    ("customers", "b_customers", "customers.credit_limit not null", "credit_limit IS NULL"),
    ("customers", "b_customers", "customers.credit_limit >= 0", "credit_limit < 0"),
    ("customers", "b_customers", "customers.credit_limit fits decimal(12,2)", "abs(credit_limit) >= 10000000000 OR credit_limit * 100 <> round(credit_limit * 100)"),
    ("customers", "b_customers", "customers.sex in (1, 2)", "sex < 1 OR sex > 2"),
    ("customers", "b_customers", "customers.education between 0 and 6", "education < 0 OR education > 6"),
    ("customers", "b_customers", "customers.marriage between 0 and 3", "marriage < 0 OR marriage > 3"),
    ("customers", "b_customers", "customers.age between 18 and 100", "age < 18 OR age > 100"),
    ("monthly_payments", "b_payments", "monthly_payments.customer_id not null", "customer_id IS NULL"),
    ("monthly_payments", "b_payments", "monthly_payments.month_number not null", "month_number IS NULL"),
    ("monthly_payments", "b_payments", "monthly_payments.month_number between 1 and 6", "month_number < 1 OR month_number > 6"),
    ("monthly_payments", "b_payments", "monthly_payments.payment_status between -2 and 9", "payment_status < -2 OR payment_status > 9"),
    ("outcomes", "b_outcomes", "outcomes.customer_id not null", "customer_id IS NULL"),
    ("outcomes", "b_outcomes", "outcomes.default_next_month not null", "default_next_month IS NULL"),
    ("outcomes", "b_outcomes", "outcomes.default_next_month in (0, 1)", "default_next_month < 0 OR default_next_month > 1"),
]
BROKEN_SETS = [("customers", CUSTOMER_RULES), ("monthly_payments", [r for r in PANEL_RULES if r.kind != "scale"]), ("outcomes", OUTCOME_RULES)]


def _all(frames):
    out = None
    for f in frames:
        out = f if out is None else out.unionByName(f)
    return out


@register("check_rules_broken", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{name}' AS rule, COUNT(*) FILTER (WHERE {bad}) AS violations FROM {source}" for t, source, name, bad in BROKEN_RULES),
    BROKEN_SQL, group="quality")
def q_check_rules_broken(spark, sf_dir):
    t = _broken(_plan(spark, sf_dir))
    return _all(qa.check(t[name], rules) for name, rules in BROKEN_SETS)


@register("enforce_summary_broken", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, COUNT(*) - COUNT(*) FILTER (WHERE {bad}) AS good_rows, COUNT(*) FILTER (WHERE {bad}) AS rejected_rows FROM {source}"
    for t, source, bad in [(t, s, " OR ".join(f"({b})" for x, _, _, b in BROKEN_RULES if x == t))
                           for t, s in (("customers", "b_customers"), ("monthly_payments", "b_payments"), ("outcomes", "b_outcomes"))]),
    BROKEN_SQL, group="quality")
def q_enforce_summary_broken(spark, sf_dir):
    t = _broken(_plan(spark, sf_dir))
    return _all(qa.enforce_summary(t[name], rules, name) for name, rules in BROKEN_SETS)


@register("duplicate_keys_broken", """
SELECT 'customers' AS table_name, 'customer_id' AS key_columns, COUNT(DISTINCT customer_id) AS duplicate_keys,
       CAST(COUNT(*) - COUNT(DISTINCT customer_id) AS BIGINT) AS excess_rows
FROM b_customers WHERE customer_id % 29 = 0""", BROKEN_SQL, group="quality")
def q_duplicate_keys_broken(spark, sf_dir):
    return qa.duplicate_summary(_broken(_plan(spark, sf_dir))["customers"], ["customer_id"], "customers")


@register("orphan_rows_broken", "SELECT 'monthly_payments' AS table_name, COUNT(*) AS orphan_rows FROM b_payments WHERE customer_id < 0",
          BROKEN_SQL, group="quality")
def q_orphan_rows_broken(spark, sf_dir):
    t = _broken(_plan(spark, sf_dir))
    return qa.orphan_summary(t["monthly_payments"], t["customers"], "customer_id", "monthly_payments")


@register("null_profile_broken", """
SELECT 0 AS customer_id_nulls, COUNT(*) - COUNT(credit_limit) AS credit_limit_nulls, COUNT(*) - COUNT(sex) AS sex_nulls,
       COUNT(*) - COUNT(education) AS education_nulls, COUNT(*) - COUNT(marriage) AS marriage_nulls, COUNT(*) - COUNT(age) AS age_nulls
FROM b_customers""", BROKEN_SQL, group="quality")
def q_null_profile_broken(spark, sf_dir):
    return qa.null_profile(_broken(_plan(spark, sf_dir))["customers"])


# ------------------------------------------------------------- the card file


def _card_file(spark, wide):
    """``wide`` as a CSV of the shared folder; names differ: binding is by position."""
    import os
    import uuid

    from cardpanel.session import checkpoint_dir
    from cardpanel.sources.files import write_table
    path = os.path.join(checkpoint_dir(spark), f"cards-{uuid.uuid4().hex[:12]}")
    write_table(wide.toDF(*[f"COL_{i}" for i in range(len(wide.columns))]), path, fmt="csv")
    return path


def _broken_records(spark, sf_dir):
    from cardpanel.sources.files import load_accounts, read_accounts
    wide, key = _wide(spark, sf_dir), F.col("id")
    text = {c: F.col(c).cast("string") for c in wide.columns}
    text["limit_bal"] = F.when(key % 13 == 0, "n/a").otherwise(text["limit_bal"])
    text["bill_amt3"] = F.when((key % 13 != 0) & (key % 17 == 0), "1.239").otherwise(text["bill_amt3"])
    first = (key % 13 != 0) & (key % 17 != 0)
    text["age"] = F.when(first & (key % 19 == 0), "17").otherwise(text["age"])
    text["default_payment_next_month"] = F.when(first & (key % 19 != 0) & (key % 23 == 0), "2").otherwise(text["default_payment_next_month"])
    return load_accounts(read_accounts(spark, _card_file(spark, wide.select(*[v.alias(c) for c, v in text.items()]))))


@register("card_file_records", """
SELECT COALESCE(why, 'good') AS outcome, COUNT(*) AS records
FROM (SELECT CASE WHEN id % 13 = 0 THEN 'limit_bal is not decimal(12,2),accounts.limit_bal not null'
                  WHEN id % 17 = 0 THEN 'bill_amt3 is not decimal(12,2)'
                  WHEN id % 19 = 0 THEN 'accounts.age between 18 and 100'
                  WHEN id % 23 = 0 THEN 'accounts.default_payment_next_month in (0, 1)' END AS why FROM wide)
GROUP BY 1""", WIDE_SQL, group="reshape")
def q_card_file_records(spark, sf_dir):
    """The card file with records broken by rule: a limit that is no number, a
    bill with a third decimal, an age under 18, a label of 2.  One decision per
    record, with its reasons."""
    loaded = _broken_records(spark, sf_dir)
    reasons = F.array_join("reasons", ",")
    return loaded.groupBy(F.when(reasons == "", "good").otherwise(reasons).alias("outcome")).agg(F.count(F.lit(1)).alias("records"))


@register("load_counts", """
SELECT outcome, COUNT(*) AS records
FROM (SELECT UNNEST(CASE WHEN id % 13 = 0 THEN ['rejected', 'limit_bal is not decimal(12,2)', 'accounts.limit_bal not null']
                         WHEN id % 17 = 0 THEN ['rejected', 'bill_amt3 is not decimal(12,2)']
                         WHEN id % 19 = 0 THEN ['rejected', 'accounts.age between 18 and 100']
                         WHEN id % 23 = 0 THEN ['rejected', 'accounts.default_payment_next_month in (0, 1)'] ELSE ['accepted'] END) AS outcome FROM wide)
GROUP BY 1""", WIDE_SQL, group="reshape")
def q_load_counts(spark, sf_dir):
    """Accepted, rejected and every reason's records of the same file, counted while it is loaded."""
    from cardpanel.sources.files import load_once, reasons_of
    _, counts = load_once(_broken_records(spark, sf_dir), reasons_of())
    return spark.createDataFrame(list(counts.items()), "outcome string, records long")


@register("csv_ingest_features", f"SELECT {FEATURE_SELECT} FROM credit_features", group="reshape")
def q_csv_ingest_features(spark, sf_dir):
    """The source-file path end to end: the wide 25-column record is written
    as CSV with a header (S6), read back with columns bound by position (S1),
    split into customers / outcomes / panel (P1, P2) and turned into features
    - equal to the features built directly from the tables."""
    from cardpanel.plans.portfolio import PortfolioPlan
    return PortfolioPlan.from_accounts(spark, _card_file(spark, _wide(spark, sf_dir))).features
