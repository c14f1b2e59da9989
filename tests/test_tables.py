from __future__ import annotations

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from cardpanel.schema import PANEL_SCHEMA
from cardpanel.sources import tables as tb
from cardpanel.sources.upsert import DuplicateSourceKey
from tests.conftest import panel_rows

KEYS, UPDATE = ["customer_id", "month_number"], ["bill_amount", "pay_amount", "payment_status"]


def files(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")}


def rows(df):
    return sorted((r.customer_id, r.month_number, float(r.bill_amount), r.payment_status) for r in df.collect())


def test_upsert_rewrites_only_touched_buckets(spark):
    root = os.path.join(tempfile.mkdtemp(prefix="cardpanel-tables-"), "panel")
    first = panel_rows(spark, [(c, m, c * 10 + m, 0, 0) for c in range(200) for m in (1, 2)])
    assert len(tb.upsert_stored(first, root, PANEL_SCHEMA, KEYS, UPDATE, buckets=16)) == 16
    before = files(root)
    change = panel_rows(spark, [(7, 2, 999, 0, 3), (7, 3, 1, 0, 0), (5000, 1, 2, 0, 0)])
    touched = tb.upsert_stored(change, root, PANEL_SCHEMA, KEYS, UPDATE, buckets=16)
    after = files(root)
    assert 1 <= len(touched) <= 2
    kept = {f for f, t in after.items() if before.get(f) == t}
    assert len(kept) == 16 - len(touched) and all(f"{tb.BUCKET}={b}/" not in f for f in kept for b in touched)
    want = {(c, m): (c * 10 + m, 0) for c in range(200) for m in (1, 2)} | {(7, 2): (999, 3), (7, 3): (1, 0), (5000, 1): (2, 0)}
    expected = sorted((*k, float(b), s) for k, (b, s) in want.items())
    assert rows(tb.read_stored(spark, root, PANEL_SCHEMA)) == expected
    tb.upsert_stored(change, root, PANEL_SCHEMA, KEYS, UPDATE, buckets=16)  # again: nothing changes
    assert rows(tb.read_stored(spark, root, PANEL_SCHEMA)) == expected
    with pytest.raises(DuplicateSourceKey):
        tb.upsert_stored(change.union(change), root, PANEL_SCHEMA, KEYS, UPDATE, buckets=16)
    assert tb.upsert_stored(change.limit(0), root, PANEL_SCHEMA, KEYS, UPDATE, buckets=16) == []


def test_refresh_that_fails_leaves_the_old_table(spark):
    root = os.path.join(tempfile.mkdtemp(prefix="cardpanel-tables-"), "features")
    with pytest.raises(FileNotFoundError):
        tb.current(spark, root)
    assert tb.refresh(spark.range(100), root) == 1
    boom = F.udf(lambda i: 1 // (0 if i == 77 else 1), "long")
    with pytest.raises(Exception, match="ZeroDivisionError|division"):
        tb.refresh(spark.range(0, 200, 1, 4).select(boom("id").alias("id")), root)
    assert tb.current(spark, root).count() == 100 and tb.versions(spark, root) == [1]
    for n in (3, 4, 5):
        tb.refresh(spark.range(n), root)
        assert tb.current(spark, root).count() == n
    assert len(tb.versions(spark, root)) == tb.KEPT == len(tb.versions(spark, root, complete=False))
