from __future__ import annotations

from fractions import Fraction
from math import floor

import numpy as np
import pytest

from cardpanel.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int, x int, n string, v long, component int"


def frame(spark, vectors, first=0):
    rows = [(first + i, None if v is None else [None if c is None else float(c) for c in v], 1, None, "n", 5, 6) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, SCHEMA)


def brute(vectors):
    """The same by one dense eigenproblem, deviations in exact fractions."""
    x = [[floor(64 * float(np.float32(c))) + 1000000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    total = [sum(r[j] for r in x) for j in range(d)]
    deviation = [sum((n * r[j] - total[j]) ** 2 for j in range(d)) for r in x]
    c = np.array([[float(Fraction(n * r[j] - total[j], n)) for j in range(d)] for r in x])
    e, u = np.linalg.eigh(c.T @ c / n)
    return deviation, c, e[::-1], u[:, ::-1]


@pytest.mark.parametrize("dim,rows,count", [(40, 300, 32), (96, 700, 32), (120, 500, 8)])
def test_equals_dense_eigenvectors(spark, dim, rows, count):
    rng = np.random.default_rng(dim)
    vectors = (rng.standard_normal((rows, dim)) * np.linspace(3, 0.5, dim) + 7).astype(np.float32)
    deviation, c, e, u = brute(vectors.tolist())
    got = {(r.vec_id, r.component): r for r in W.whitened(frame(spark, vectors), count).collect()}
    assert len(got) == rows * count
    for j in range(count):
        z = np.array([got[i, j + 1].whitened for i in range(rows)])
        expected = c @ u[:, j] / np.sqrt(e[j])
        assert min(np.abs(z - expected).max(), np.abs(z + expected).max()) < 1e-7
        assert got[0, j + 1].explained == pytest.approx(e[j] / e.sum(), rel=1e-12)
    assert [got[i, 1].deviation for i in range(rows)] == deviation
    assert {r.n for r in got.values()} == {rows} and len({r.identity_error for r in got.values()}) == 1
    assert got[0, 1].identity_error < 1e-10 and got[0, 1].residual < 1e-11


def test_steep_and_close_spectra(spark):
    rng = np.random.default_rng(3)
    for scale in (np.concatenate([[2e4, 900], np.full(88, 1.0)]), np.geomspace(1e3, 1, 90)):
        vectors = (rng.standard_normal((400, 90)) * scale).astype(np.float32)
        rows, dim = W.integral(frame(spark, vectors))
        values, basis, worst = W.leading(W.Centred(rows, dim), 12)
        _, c, e, u = brute(vectors.tolist())
        assert np.abs(values / e[:12] - 1).max() < 1e-9 and worst < 1e-10 * e[0]
        cov = c.T @ c / len(c)
        assert np.abs(cov @ basis - basis * values).max() < 1e-9 * e[0]


def test_block_grows_where_the_filter_gains_nothing(spark):
    vectors = np.kron(np.eye(80), np.ones((2, 1))) * np.where(np.arange(160) % 2, 10, -10)[:, None]  # equal eigenvalues
    got = W.whitened(frame(spark, vectors.tolist())).toPandas()
    assert len(got) == 160 * 32 and got["identity_error"].max() < 1e-9


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [1, None, 2], [nan, 0, 0], [0, inf, 0], [1, 2], [1, 2, 3], [1, 2, 3], [4, 1, -3], [0, 0, 0]]
    got = W.whitened(frame(spark, odd))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "residual"]
    rows = got.collect()
    assert {r.vec_id for r in rows} == {6, 7, 8, 9} and {r.n for r in rows} == {4}
    assert {r.component for r in rows} == {1, 2} and len(rows) == 8  # the third has no variance
    by = {(r.vec_id, r.component): r for r in rows}
    assert by[6, 1].whitened == by[7, 1].whitened and by[6, 1].deviation == by[7, 1].deviation
    assert W.whitened(frame(spark, [[1, 2, 3]] * 3)).count() == 0
    assert W.whitened(frame(spark, [[1, 2]])).count() == 0
    assert W.whitened(frame(spark, [])).count() == 0
    far = {r.vec_id: r.deviation for r in W.whitened(frame(spark, [[1e9, 0], [-1e9, 0], [0, 1]])).collect()}
    assert far == {0: None, 1: None, 2: 128**2}  # (n x - S)^2 beyond a long
