from __future__ import annotations

import os
import tempfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cardpanel.operators import panel as pn
from cardpanel.operators import quality as qa
from cardpanel.schema import CUSTOMER_RULES, CUSTOMERS_SCHEMA, Rule, with_comments
from cardpanel.sources import files
from cardpanel.sources.jdbc import jdbc_options
from cardpanel.sources.upsert import DuplicateSourceKey, upsert


def test_upsert_semantics(spark):
    target = spark.createDataFrame([(1, 10.0, "a", "t0"), (2, 20.0, "b", "t0"), (3, 30.0, "c", "t0")],
                                   "k long, v double, other string, created_at string")
    source = spark.createDataFrame([(2, 21.0, "B"), (3, None, "C"), (4, 40.0, "D")], "k long, v double, other string")
    out = {r["k"]: r.asDict() for r in upsert(target, source, ["k"], ["v"], created_col="created_at").collect()}
    assert out[1] == {"k": 1, "v": 10.0, "other": "a", "created_at": "t0"}          # untouched
    assert out[2]["v"] == 21.0 and out[2]["other"] == "b" and out[2]["created_at"] == "t0"  # update keeps rest
    assert out[3]["v"] is None                                                       # explicit NULL overwrites
    assert out[4]["v"] == 40.0 and out[4]["other"] == "D" and out[4]["created_at"] is not None  # insert
    dup = spark.createDataFrame([(5, 1.0, "x"), (5, 2.0, "y")], "k long, v double, other string")
    with pytest.raises(DuplicateSourceKey):
        upsert(target, dup, ["k"], ["v"])


def test_upsert_composite_key(spark):
    t = spark.createDataFrame([(1, 1, 5.0), (1, 2, 6.0)], "c long, m int, v double")
    s = spark.createDataFrame([(1, 2, 7.0), (1, 3, 8.0)], "c long, m int, v double")
    out = sorted(tuple(r) for r in upsert(t, s, ["c", "m"], ["v"]).collect())
    assert out == [(1, 1, 5.0), (1, 2, 7.0), (1, 3, 8.0)]


def test_rules_null_passes_and_one_breach_per_rule(spark):
    rows = [(1, Decimal("100.00"), 1, 1, 1, 30), (2, Decimal("-1.00"), 3, 7, 4, 17), (3, Decimal("5.00"), None, None, None, None)]
    df = spark.createDataFrame(rows, CUSTOMERS_SCHEMA)
    got = {r["rule"]: r["violations"] for r in qa.check(df, CUSTOMER_RULES).collect()}
    assert got["customers.credit_limit >= 0"] == 1
    assert got["customers.sex in (1, 2)"] == 1
    assert got["customers.education between 0 and 6"] == 1
    assert got["customers.marriage between 0 and 3"] == 1
    assert got["customers.age between 18 and 100"] == 1
    assert got["customers.customer_id not null"] == 0
    e = qa.enforce(df, CUSTOMER_RULES)
    assert qa.good(e).count() == 2 and qa.rejected(e).count() == 1


def test_load_rejects_scale_surplus_and_range(spark):
    d = tempfile.mkdtemp(prefix="cardpanel-csv-")
    base = ["1", "20000", "2", "2", "1", "24", "2", "2", "-1", "-1", "-2", "-2"] + ["3913.50"] * 6 + ["0"] * 6 + ["1"]
    with open(os.path.join(d, "raw.csv"), "w") as fh:
        rows = [base, ["2", "20000.001", *base[2:]], ["3", *base[1:], "9"], ["4", *base[1:5], "17", *base[6:]], ["5", *base[1:6], "x", *base[7:]],
                ["6", "99999999999999", *base[2:]], ["7", "", *base[2:]]]
        fh.write("\n".join([",".join("c" * 25), *map(",".join, rows)]) + "\n")
    kept, rejected = files.split_records(files.load_accounts(files.read_accounts(spark, d)))
    assert [r["id"] for r in kept.collect()] == [1]
    why = {r["id"]: r["reasons"][0] for r in rejected.collect()}
    assert why == {2: "limit_bal is not decimal(12,2)", 3: "surplus fields", 4: "accounts.age between 18 and 100", 5: "pay_0 is not smallint",
                   6: "limit_bal is not decimal(12,2)", 7: "accounts.limit_bal not null"}


def test_long_bounds_keep_their_digits(spark):
    df = spark.createDataFrame([(1234567,), (1234568,), (1234570,)], "x long")
    r = Rule("t", "x", "range", 0, 1234567)
    assert qa.check(df, [r]).first()["violations"] == 2 and r.name == "t.x between 0 and 1234567"


def test_scale_rule_on_text(spark):
    df = spark.createDataFrame([("1.239",), ("1.23",), ("1.230",), (None,), ("abc",)], "x string")
    assert qa.check(df, [Rule("t", "x", "scale", precision=12, scale=2)]).first()["violations"] == 2


def test_scale_rule(spark):
    df = spark.createDataFrame([(1, 123456789012.5), (2, 12.5)], "id long, x double")
    r = Rule("t", "x", "scale", precision=12, scale=2)
    assert qa.check(df, [r]).first()["violations"] == 1


def test_duplicates_and_orphans(spark):
    a = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, 1)], "customer_id long, m int")
    assert [tuple(r) for r in qa.duplicates(a, ["customer_id", "m"]).collect()] == [(1, 1, 2)]
    parent = spark.createDataFrame([(1,)], "customer_id long")
    assert qa.orphans(a, parent, "customer_id").count() == 1


def test_wide_panel_round_trip(spark):
    from tests.conftest import customer_rows, dense, panel_rows
    panel = panel_rows(spark, dense(7, [1, 2, 3, 4, 5, 6], [6, 5, 4, 3, 2, 1], [0, 1, 2, -1, -2, 3]))
    cust = customer_rows(spark, [(7, 5000)])
    outc = spark.createDataFrame([(7, 1)], "customer_id long, default_next_month int")
    wide = pn.to_wide(panel, cust, outc)
    assert wide.columns[:12] == ["id", "limit_bal", "sex", "education", "marriage", "age",
                                 "pay_0", "pay_2", "pay_3", "pay_4", "pay_5", "pay_6"]
    assert len(wide.columns) == 25
    back = sorted(tuple(r) for r in pn.to_panel(wide).collect())
    assert back == sorted(tuple(r) for r in panel.collect())
    c, o, p = pn.split_accounts(wide)
    assert o.first()["default_next_month"] == 1 and c.first()["credit_limit"] == Decimal("5000.00")


def test_csv_positional_binding_and_corrupt_rows(spark):
    d = tempfile.mkdtemp(prefix="cardpanel-csv-")
    path = os.path.join(d, "raw.csv")
    header = ",".join(f"COL{i}" for i in range(25))
    good = ",".join(["1", "20000", "2", "2", "1", "24", "2", "2", "-1", "-1", "-2", "-2"] + ["3913"] * 6 + ["0"] * 6 + ["1"])
    short = "2,50000,1"
    bad = good.replace("20000", "abc", 1).replace("1,", "3,", 1)
    with open(path, "w") as fh:
        fh.write("\n".join([header, good, short, bad]) + "\n")
    loaded = files.load_accounts(files.read_accounts(spark, path))
    kept, rejected = files.split_records(loaded)
    rows = kept.collect()
    assert len(rows) == 1 and rows[0]["limit_bal"] == Decimal("20000.00") and rows[0]["pay_0"] == 2 and rows[0]["default_payment_next_month"] == 1
    why = {r["id"]: set(r["reasons"]) for r in rejected.collect()}
    assert why[2] == {"accounts.default_payment_next_month not null"}
    assert why[3] == {"limit_bal is not decimal(12,2)", "accounts.limit_bal not null"}
    # one decision per record, whatever is read of it
    customers, outcomes, panel = pn.split_accounts(kept)
    assert customers.count() == outcomes.count() == 1 and panel.count() == 6
    renamed = files.normalise_columns(spark.createDataFrame([(1, 0)], "`ID ` long, `default payment next month` int"))
    assert renamed.columns == ["ID", "default.payment.next.month"]


def test_write_and_copy_if_exists(spark):
    d = tempfile.mkdtemp(prefix="cardpanel-io-")
    df = spark.createDataFrame([(1, "a")], "k long, v string")
    files.write_table(df, os.path.join(d, "t"), fmt="csv", small=True)
    assert files.read_table(spark, os.path.join(d, "t"), fmt="csv").count() == 1
    rep = files.copy_if_exists(spark, os.path.join(d, "t"), os.path.join(d, "u")).first()
    assert rep["status"] == "copied"
    assert files.copy_if_exists(spark, os.path.join(d, "missing"), os.path.join(d, "v")).first()["status"] == "skipped"
    m = spark.createDataFrame([(3, ["a", "b"])], "accounts long, top_features array<string>")
    files.write_metrics(m, os.path.join(d, "metrics"))
    assert spark.read.json(os.path.join(d, "metrics")).first()["accounts"] == 3


def test_comments_and_jdbc_options(spark):
    df = spark.createDataFrame([(1, Decimal("1.00"), 1, 1, 1, 30)], CUSTOMERS_SCHEMA)
    c = with_comments(df.select("customer_id", "credit_limit"), CUSTOMERS_SCHEMA)
    assert "exposure" in c.schema["credit_limit"].metadata["comment"]
    o = jdbc_options({"DB_HOST": "db", "DB_PASSWORD": "x"}, query="select 1")
    assert o["url"] == "jdbc:postgresql://db:5432/credit_risk" and o["query"] == "select 1"
    p = jdbc_options({}, query="select * from t", partition_column="id", lower=0, upper=100, num_partitions=4)
    assert p["dbtable"].startswith("(select") and p["numPartitions"] == "4"


def test_load_timestamp_and_panel_id(spark):
    from tests.conftest import dense, panel_rows
    p = panel_rows(spark, dense(3, [1] * 6, [1] * 6, [0] * 6))
    ids = [r["id"] for r in pn.with_panel_id(p).orderBy("month_number").collect()]
    assert ids == [19, 20, 21, 22, 23, 24]
    assert files.with_load_ts(p).select(F.countDistinct("created_at")).first()[0] == 1
