from __future__ import annotations

import json
import os
import subprocess
import sys
import tempfile

import cardpanel
from tests.conftest import SF001


def test_lazy_package_api():
    assert callable(cardpanel.credit_features) and callable(cardpanel.roll_rates)
    assert cardpanel.PortfolioPlan.__name__ == "PortfolioPlan"


def test_command_line_build():
    out = os.path.join(tempfile.mkdtemp(prefix="cardpanel-cli-"), "out")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    r = subprocess.run([sys.executable, "-m", "cardpanel.plans.exports", "--data", SF001, "--out", out,
                        "--master", "local[2]"], cwd=root, capture_output=True, text=True, timeout=600)
    assert r.returncode == 0, r.stderr[-2000:]
    written = json.loads(r.stdout[r.stdout.index("{"):])
    assert {"monthly_payments", "credit_features", "roll_rate_matrix", "metrics"} <= set(written)
    assert os.path.isdir(os.path.join(out, "dashboard", "portfolio_overview"))


def test_command_line_build_from_a_card_file(spark):
    from pyspark.sql import functions as F

    from cardpanel.operators.panel import to_wide
    from cardpanel.plans.portfolio import PortfolioPlan
    d = tempfile.mkdtemp(prefix="cardpanel-cards-")
    p = PortfolioPlan(spark, SF001)
    wide = to_wide(p.panel, p.customers, p.outcomes)
    wide.withColumn("age", F.when(F.col("id") == 1, 17).otherwise(F.col("age"))).write.option("header", True).csv(os.path.join(d, "cards"))
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    r = subprocess.run([sys.executable, "-m", "cardpanel.plans.exports", "--accounts", os.path.join(d, "cards"), "--out", os.path.join(d, "out"),
                        "--master", "local[2]"], cwd=root, capture_output=True, text=True, timeout=600)
    assert r.returncode == 0, r.stderr[-2000:]
    read = lambda name: spark.read.parquet(os.path.join(d, "out", "processed", name))
    assert [x["id"] for x in read("rejected_records").collect()] == [1]
    assert read("customers").count() == p.customers.count() - 1 and "created_at" in read("customers").columns
    mine = {x["customer_id"]: x["avg_utilization"] for x in read("credit_features").collect()}
    assert mine == {x["customer_id"]: x["avg_utilization"] for x in p.features.collect() if x["customer_id"] != 1}
