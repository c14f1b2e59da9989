from __future__ import annotations

import os
import sys
from decimal import Decimal

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from cardpanel.session import build_session, checkpoint_dir
    s = build_session("local[4]", shuffle_partitions=4, app="cardpanel-tests")
    checkpoint_dir(s)
    yield s
    s.stop()


def panel_rows(spark, rows):
    """rows: (customer_id, month, bill, pay, status)"""
    from cardpanel.schema import PANEL_SCHEMA
    conv = [(c, m, None if b is None else Decimal(str(b)), None if p is None else Decimal(str(p)), s)
            for c, m, b, p, s in rows]
    return spark.createDataFrame(conv, PANEL_SCHEMA)


def customer_rows(spark, rows):
    """rows: (customer_id, limit)"""
    from cardpanel.schema import CUSTOMERS_SCHEMA
    return spark.createDataFrame([(c, Decimal(str(lim)), 1, 1, 1, 30) for c, lim in rows], CUSTOMERS_SCHEMA)


def dense(cid, bills, pays, statuses):
    return [(cid, m + 1, bills[m], pays[m], statuses[m]) for m in range(6)]
