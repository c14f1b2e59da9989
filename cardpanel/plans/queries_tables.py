"""Registered queries: tables written and read again, views, orders, types, model inputs."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cardpanel.functions.columns import money_text, pct_text
from cardpanel.operators import modeling as md
from cardpanel.operators import quality as qa
from cardpanel.operators import tiers as tr
from cardpanel.operators.features import clean_features
from cardpanel.plans.catalog import FEATURE_SELECT, N, RATE, _plan, register
from cardpanel.plans.oracle import measured
from cardpanel.plans.queries_model import HASH, RANK_SQL, frame_of, logistic_of
from cardpanel.schema import CUSTOMERS_SCHEMA, FEATURES, PANEL_SCHEMA, TIER_ORDER, with_comments
from cardpanel.session import checkpoint_dir
from cardpanel.sources import files, tables
from cardpanel.sources.starschema import sparse_panel
from cardpanel.sources.views import register_views


def _folder(spark, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/queries/{name}-{uuid.uuid4().hex}"


def _money(df):
    return df.withColumns({c: F.col(c).cast("double") for c, t in df.dtypes if t.startswith("decimal")})


# What the second load of ``upsert_stored`` brings, in both engines' SQL: corrected late
# months, and all months of accounts that were inactive.
CORRECTED = "customer_id % 3 = 0 AND month_number >= 5"


@register("upsert_stored", f"""
SELECT customer_id, month_number, CAST(bill_amount AS DOUBLE) + CASE WHEN {CORRECTED} THEN 1 ELSE 0 END AS bill_amount,
       CAST(pay_amount AS DOUBLE) AS pay_amount, CASE WHEN {CORRECTED} THEN 9 ELSE payment_status END AS payment_status
FROM monthly_payments WHERE payment_status > -2 OR {CORRECTED}""", group="tables")
def q_upsert_stored(spark, sf_dir):
    """The active months are stored; a second load corrects some months, and adds some
    that were missing, of a third of the accounts."""
    p, root = _plan(spark, sf_dir), _folder(spark, "panel")
    keys, update = ["customer_id", "month_number"], ["bill_amount", "pay_amount", "payment_status"]
    tables.upsert_stored(sparse_panel(p.panel), root, PANEL_SCHEMA, keys, update)
    late = p.panel.filter(CORRECTED).withColumns({
        "bill_amount": (F.col("bill_amount") + 1).cast(PANEL_SCHEMA["bill_amount"].dataType), "payment_status": F.lit(9).cast(PANEL_SCHEMA["payment_status"].dataType)})
    tables.upsert_stored(late, root, PANEL_SCHEMA, keys, update)
    return _money(tables.read_stored(spark, root, PANEL_SCHEMA)).withColumn("payment_status", F.col("payment_status").cast("int"))


@register("full_refresh", f"SELECT {FEATURE_SELECT} FROM credit_features", group="tables")
def q_full_refresh(spark, sf_dir):
    """A table of tiers, replaced as a whole by the features."""
    p, root = _plan(spark, sf_dir), _folder(spark, "refreshed")
    tables.refresh(p.tiers, root)
    tables.refresh(p.features, root)
    return tables.current(spark, root)


@register("csv_round_trip", """
SELECT customer_id, CAST(credit_limit AS DOUBLE) AS credit_limit, CAST(sex AS INTEGER) AS sex, age FROM customers""", group="tables")
def q_csv_round_trip(spark, sf_dir):
    """Customers written as CSV under raw header names, read again, the names cleaned."""
    path = _folder(spark, "customers")
    c = _plan(spark, sf_dir).customers.select("customer_id", F.col("credit_limit").cast("double"), F.col("sex").cast("int"), "age")
    files.write_table(c.toDF(*[f" {n} " for n in c.columns]), path, "csv")
    out = files.normalise_columns(files.read_table(spark, path, "csv"))
    return out.select(*[F.col(n).cast(t) for n, t in c.dtypes])


@register("metrics_record", """
SELECT COUNT(*) AS accounts, 100.0 * SUM(default_next_month) / COUNT(*) AS overall_default_rate,
       CAST(SUM(credit_limit) AS DOUBLE) * (1.0 / 31.0) AS total_exposure_usd FROM acct_v""", group="tables")
def q_metrics_record(spark, sf_dir):
    """The figures of the portfolio written as a JSON record and read again."""
    path = _folder(spark, "metrics")
    files.write_metrics(tr.portfolio_kpis(_plan(spark, sf_dir).view).select("accounts", "overall_default_rate", "total_exposure_usd"), path)
    return files.read_table(spark, path, "json")


@register("named_views", "SELECT delinquency_bucket, month_number, COUNT(*) AS statements FROM delinquency_buckets GROUP BY ALL", group="tables")
def q_named_views(spark, sf_dir):
    """SQL over the named views."""
    p = _plan(spark, sf_dir)
    register_views(p.customers, p.panel, p.outcomes, p.features, p.tiers)
    return spark.sql("SELECT delinquency_bucket, month_number, count(*) AS statements FROM delinquency_buckets GROUP BY ALL")


@register("ordered_tiers", f"""
SELECT *, ROW_NUMBER() OVER (ORDER BY CASE risk_tier {" ".join(f"WHEN '{t}' THEN {i}" for i, t in enumerate(TIER_ORDER))} END) - 1 AS position
FROM ({measured("acct_v", "risk_tier", {"account_count": N, "default_rate_pct": RATE})})""", group="tables")
def q_ordered_tiers(spark, sf_dir):
    """Tiers in their own order, with the place that the sorted result gives each."""
    p = _plan(spark, sf_dir)
    rows = tr.ordered(tr.tier_default_rate(p.tiers, p.outcomes), ["risk_tier"], {"risk_tier": TIER_ORDER}).coalesce(1)  # three rows
    return rows.withColumn("position", F.monotonically_increasing_id())


@register("ordered_levels", """
SELECT *, ROW_NUMBER() OVER (ORDER BY default_rate_pct DESC, max_delinquency) - 1 AS position
FROM (""" + measured("acct_v", "max_delinquency", {"account_count": N, "default_rate_pct": RATE}) + ")", group="tables")
def q_ordered_levels(spark, sf_dir):
    """Delinquency levels by falling default rate; one row a level."""
    from cardpanel.operators.features import delinquency_levels
    p = _plan(spark, sf_dir)
    rows = tr.ordered(delinquency_levels(p.features, p.outcomes), [F.col("default_rate_pct").desc_nulls_last(), "max_delinquency"]).coalesce(1)
    return rows.withColumn("position", F.monotonically_increasing_id())


# Column types of the derived tables.
TYPED = {"customers": "bigint decimal(12,2) smallint smallint smallint int", "outcomes": "bigint int"}


@register("shape_and_types", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{kind}' AS data_type, {i} AS position, (SELECT COUNT(*) FROM {t}) AS rows"
    for t, names in (("customers", CUSTOMERS_SCHEMA.fieldNames()[:6]), ("outcomes", ["customer_id", "default_next_month"]))
    for i, (c, kind) in enumerate(zip(names, TYPED[t].split()))), group="tables")
def q_shape_and_types(spark, sf_dir):
    p = _plan(spark, sf_dir)
    return qa.shape_and_types(p.customers.select(*CUSTOMERS_SCHEMA.fieldNames()[:6]), "customers").unionByName(qa.shape_and_types(p.outcomes, "outcomes"))


@register("column_comments", " UNION ALL ".join(
    f"SELECT '{f.name}' AS column_name, '{f.metadata.get('comment', '').replace(chr(39), chr(39) * 2)}' AS comment, COUNT({f.name}) AS filled FROM monthly_payments"
    for f in PANEL_SCHEMA.fields), group="tables")
def q_column_comments(spark, sf_dir):
    """Comments that went with the panel through a stored table, and how many values each column holds."""
    path = _folder(spark, "commented")
    with_comments(_plan(spark, sf_dir).panel.select(*PANEL_SCHEMA.fieldNames()), PANEL_SCHEMA).write.parquet(path)
    back = spark.read.parquet(path)
    notes = spark.createDataFrame([(f.name, f.metadata.get("comment", "")) for f in back.schema.fields], "column_name string, comment string")
    filled = back.agg(*[F.count(c).alias(c) for c in back.columns]).unpivot([], back.columns, "column_name", "filled")
    return notes.join(filled, "column_name")


@register("formatted_tiers", """
SELECT risk_tier, format('{:.1f}%', default_rate_pct) AS default_rate, format('${:,}', CAST(ROUND(exposure, 0) AS BIGINT)) AS exposure
FROM (""" + measured("acct_v", "risk_tier", {"default_rate_pct": RATE, "exposure": "CAST(SUM(credit_limit) AS DOUBLE)"}) + ")", group="tables")
def q_formatted_tiers(spark, sf_dir):
    """Rates and amounts as text."""
    p = _plan(spark, sf_dir)
    t = tr.tier_default_rate(p.tiers, p.outcomes).join(tr.tier_exposure(p.tiers, p.customers), "risk_tier")
    return t.select("risk_tier", pct_text("default_rate_pct").alias("default_rate"), money_text("total_credit_exposure_twd").alias("exposure"))


def _broken(column: str, nan: str, inf: str) -> str:
    return f"CASE WHEN customer_id % 5 = 0 THEN {nan} WHEN customer_id % 7 = 0 THEN -{inf} WHEN customer_id % 11 = 0 THEN NULL ELSE CAST({column} AS DOUBLE) END"


@register("clean_features", "SELECT customer_id, " + ", ".join(
    f"CASE WHEN customer_id % 5 = 0 OR customer_id % 7 = 0 OR customer_id % 11 = 0 THEN 0.0 ELSE CAST({c} AS DOUBLE) END AS {c}" for c in FEATURES)
    + " FROM credit_features", group="tables")
def q_clean_features(spark, sf_dir):
    """NaN, infinite and missing values in a third of the rows become 0."""
    f = _plan(spark, sf_dir).features
    broken = f.selectExpr("customer_id", *[f"{_broken(c, 'double(\"NaN\")', 'double(\"Infinity\")')} AS {c}" for c in FEATURES])
    return clean_features(broken).select("customer_id", *FEATURES)


@register("standardized_features", "SELECT customer_id, " + ", ".join(
    f"ROUND((CAST({c} AS DOUBLE) - AVG({c}) OVER ()) / NULLIF(STDDEV_POP({c}) OVER (), 0), 6) AS {c}" for c in FEATURES) + " FROM credit_features", group="tables")
def q_standardized_features(spark, sf_dir):
    z = md.standardize(_plan(spark, sf_dir).features)
    return z.select("customer_id", *[F.round(c, 6).alias(c) for c in FEATURES])


@register("sample_hundred", f"""
SELECT customer_id, avg_utilization, max_delinquency, on_time_months FROM credit_features ORDER BY {HASH}, customer_id LIMIT 100""", group="tables")
def q_sample_hundred(spark, sf_dir):
    """A seeded sample of fewer rows than there are."""
    return md.sample_n(_plan(spark, sf_dir).features, 100).select("customer_id", "avg_utilization", "max_delinquency", "on_time_months")


def _newton_sql(steps: int = 9) -> tuple[str, str]:
    """(select, tables): Newton's steps on the scaled training rows, each with a
    Gauss-Jordan elimination of its own, written out."""
    k = len(FEATURES) + 1
    x = ["1.0", *FEATURES]
    dot = " + ".join(f"b[{i + 1}] * {v}" for i, v in enumerate(x))
    cell = lambda i, j: f"SUM(weight * p * (1 - p) * {x[i]} * {x[j]})" + (" + 1.0" if i == j > 0 else "")
    right = lambda i: f"SUM(weight * (y - p) * {x[i]})" + (f" - ANY_VALUE(b[{i + 1}])" if i else "")
    matrix = ", ".join("[" + ", ".join([*(cell(i, j) for j in range(k)), right(i)]) + "]" for i in range(k))
    scaled = ", ".join(f"(CAST({c} AS DOUBLE) - AVG({c}) OVER ()) / STDDEV_POP({c}) OVER () AS {c}" for c in FEATURES)
    parts = [f"""z AS MATERIALIZED (
  SELECT default_next_month AS y, COUNT(*) OVER () / (2.0 * COUNT(*) OVER (PARTITION BY default_next_month)) AS weight, {scaled}
  FROM credit_features JOIN ranked USING (customer_id) WHERE rk >= ROUND(0.2 * n))""",
             f"b0 AS MATERIALIZED (SELECT [{', '.join(['0.0::DOUBLE'] * k)}] AS b)"]
    for s in range(steps):
        parts.append(f"m{s}_0 AS MATERIALIZED (SELECT [{matrix}] AS a FROM (SELECT z.*, b, 1 / (1 + EXP(-({dot}))) AS p FROM z, b{s}))")
        for j in range(1, k + 1):
            parts.append(f"""m{s}_{j} AS MATERIALIZED (SELECT list_transform(a, lambda r, i: CASE WHEN i = {j} THEN list_transform(r, lambda v: v / a[{j}][{j}])
  ELSE list_transform(r, lambda v, c: v - r[{j}] * a[{j}][c] / a[{j}][{j}]) END) AS a FROM m{s}_{j - 1})""")
        parts.append(f"b{s + 1} AS MATERIALIZED (SELECT list_transform(b, lambda v, i: v + a[i][{k + 1}]) AS b FROM b{s}, m{s}_{k})")
    names = ", ".join(f"'{n}'" for n in ["intercept", *FEATURES])
    return f"SELECT UNNEST([{names}]) AS name, UNNEST(list_transform(b, lambda v: ROUND(v, 4))) AS coefficient FROM b{steps}", RANK_SQL + ", " + ",\n".join(parts)


@register("logistic_newton", *_newton_sql(), group="model")
def q_logistic_newton(spark, sf_dir):
    """Coefficients of the balanced logistic baseline at its optimum, on scaled features."""
    train = frame_of(_plan(spark, sf_dir)).filter("split = 'train'")
    rows = [(n, round(v, 4)) for n, v in md.newton_logistic(train).items()]
    return spark.createDataFrame(rows, "name string, coefficient double")


@register("logistic_coefficients", group="model")
def q_logistic_coefficients(spark, sf_dir):
    """Coefficients of the stored logistic model; tests hold them against ``logistic_newton``."""
    _, t = logistic_of(_plan(spark, sf_dir))
    return spark.createDataFrame([("intercept", float(t.model.intercept)), *md.logistic_coefficients(t).items()], "name string, coefficient double")
