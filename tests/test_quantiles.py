from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from cardpanel.operators import quantiles as qn

QUARTILES = (0.25, 0.5, 0.75)


def table(seed, n=3000):
    rng = np.random.default_rng(seed)
    return pd.DataFrame({"y": rng.integers(0, 3, n), "even": rng.random(n), "heavy": rng.lognormal(5, 2, n), "ties": rng.integers(0, 4, n).astype(float),
                         "hot": np.where(rng.random(n) < 0.4, 7.0, rng.normal(0, 50, n))})


def check(df, got, probs=QUARTILES):
    names = [c for c in df.columns if c != "y"]
    want = {(c, k): (len(v), [float(np.quantile(v, p)) for p in probs]) for c, g in df.groupby("y") for k in names for v in [g[k].dropna().to_numpy()] if len(v)}
    assert set(got) == set(want)
    for key, (n, values) in want.items():
        assert got[key][0] == n and got[key][1] == pytest.approx(values, rel=1e-12, abs=1e-12), key


def test_equal_sorted_values(spark):
    df = table(1)
    check(df, qn.class_quantiles(spark.createDataFrame(df), ["even", "heavy", "ties", "hot"], "y", QUARTILES))


def test_crowded_brackets_are_narrowed(spark, monkeypatch):
    monkeypatch.setattr(qn, "ACCURACY", 20)
    monkeypatch.setattr(qn, "INSIDE", 30)
    df = table(2)
    check(df, qn.class_quantiles(spark.createDataFrame(df), ["even", "heavy", "ties", "hot"], "y", (0.1, *QUARTILES, 0.99)), (0.1, *QUARTILES, 0.99))


def test_missed_brackets_are_widened(spark, monkeypatch):
    df, calls, real = table(3), [], qn._brackets

    def shifted(*args):
        calls.append(args[-1])
        found = real(*args)
        return found if len(calls) > 1 else {k: (n, [(-2e18, -1e18, spots) for _, _, spots in b]) for k, (n, b) in found.items()}

    monkeypatch.setattr(qn, "_brackets", shifted)
    check(df, qn.class_quantiles(spark.createDataFrame(df), ["even", "heavy", "ties", "hot"], "y", QUARTILES))
    assert len(calls) == 2 and calls[1] > calls[0]


def test_nulls_single_values_and_nothing(spark):
    rows = [(0, 1.0, None), (0, None, None), (1, 5.0, 2.0), (1, 5.0, 3.0), (None, 4.0, 1.0)]
    df = spark.createDataFrame(rows, "y int, a double, b double")
    got = qn.class_quantiles(df, ["a", "b"], "y", QUARTILES)
    assert got == {(0, "a"): (1, [1.0] * 3), (1, "a"): (2, [5.0] * 3), (1, "b"): (2, [2.25, 2.5, 2.75]), (None, "a"): (1, [4.0] * 3), (None, "b"): (1, [1.0] * 3)}
    assert qn.class_quantiles(df.limit(0), ["a"], "y", QUARTILES) == {}
