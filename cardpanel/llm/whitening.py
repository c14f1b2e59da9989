"""Embedding whitening by Chebyshev-filtered subspace iteration.

Entries become whole numbers x = floor(64 c) + 1000000, so means and deviations are
exact.  A block of ``COMPONENTS`` + ``GUARD`` orthonormal columns Q is improved until
it holds the leading eigenvectors of the covariance V of x:

1. One pass over all rows gives V Q = Xc' (Xc Q) / n (rows are centred before they are
   multiplied; each task sends one d x k matrix, and Spark adds them up).
2. Rayleigh-Ritz: the eigenvectors of Q' V Q turn Q, and the residuals |V q - e q| of
   the wanted columns are bounds on the error of e, and over the gap to the next
   eigenvalue on that of q.  Once they are at rounding level the block is certified.
3. Otherwise a Chebyshev polynomial of V, by its three-term recurrence (one pass a
   degree), damps the interval from the bottom of the spectrum to the least Ritz value
   and magnifies what lies above; QR follows, and back to 2.  The degree is held so low
   that the columns stay independent.  Where the wanted values are so close to the
   interval that a degree gains nothing, the block is doubled, up to the whole space.

Only d x k matrices reach the driver; rows are stored once and read in every pass.

Defined results: rows whose vector is null or empty, or holds null or non-finite
entries, are left out, as are vectors of another length than the most common one
(ties: the longer); rows with null or repeated vec_id are rows of their own; equal
eigenvalues have an arbitrary basis of their space, the same for all rows; components
of no variance (below ``FLAT`` of the first) can't be whitened and are left out, so
equal rows, a single row and an empty table give no rows; a deviation beyond a long is
null; entries beyond the range of x raise an error; other columns are never read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardpanel.llm.tables import stored
from cardpanel.llm.vectors import finite, matrix

COMPONENTS, GUARD, DEGREE = 32, 16, 12
#: Residuals over the first eigenvalue: rounding level (for each root of d), and the most that is accepted where they stop falling.
EXACT, ENOUGH = 4e-15, 1e-11
#: Columns may drift this far apart in one filter; growth per degree below which the block is doubled.
DRIFT, SLOW = 1e8, 0.05
FLAT = 1e-12
#: Rows of a block in a task.
ROWS = 4096


def integral(vectors: DataFrame) -> tuple[DataFrame, int]:
    """(vec_id, x) of the usable rows, stored, and the number of dimensions."""
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("v")).filter(finite("v"))
    rows = stored(rows.select("vec_id", F.transform("v", lambda c: F.floor(64 * c) + 1000000).alias("x")), "whitening-x")
    common = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    dim = common["d"] if common else 0
    return rows.filter(F.size("x") == dim), dim


class Centred:
    """Rows, their number, exact sums, and passes over them."""

    def __init__(self, rows: DataFrame, dim: int):
        self.rows, self.dim = rows, dim
        sums = rows.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v"), F.count("*").alias("n")).collect()
        self.n = sums[0]["n"] if sums else 0
        total = np.zeros(dim, object)
        for r in sums:
            total[r["i"]] = r["v"]
        n = max(self.n, 1)
        #: Mean = whole + left / n.
        self.whole, self.left = np.array([t // n for t in total], np.int64), np.array([t % n for t in total], np.int64)

    def rest(self) -> np.ndarray:
        return self.left / max(self.n, 1)

    def summed(self, work, size: int) -> np.ndarray:
        """Sum over all rows of the ``size`` numbers that ``work`` makes of a centred block."""
        dim, whole, rest = self.dim, self.whole, self.rest()

        def run(batches):
            total = np.zeros(size)
            for batch in batches:
                for lo in range(0, batch.num_rows, ROWS):
                    total += work((matrix(batch.column(0).slice(lo, ROWS), dim) - whole) - rest)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], ["i", "v"])

        parts = self.rows.select("x").mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).toArrow()
        out = np.zeros(size)
        out[parts["i"].to_numpy()] = parts["v"].to_numpy()
        return out

    def times(self, q: np.ndarray) -> np.ndarray:
        """V q: one pass."""
        shared = self.rows.sparkSession.sparkContext.broadcast(q)
        out = self.summed(lambda x: (x.T @ (x @ shared.value)).ravel(), q.size).reshape(q.shape) / self.n
        shared.unpersist()
        return out


def _filtered(data: Centred, q: np.ndarray, vq: np.ndarray, low: float, high: float, top: float, degree: int) -> np.ndarray:
    """The scaled Chebyshev polynomial of V over [low, high], times q."""
    half, mid = (high - low) / 2, (high + low) / 2
    first = s = half / (top - mid)
    before, now = q, (vq - mid * q) * (s / half)
    for _ in range(degree - 1):
        s_next = 1 / (2 / first - s)
        before, now = now, (data.times(now) - mid * now) * (2 * s_next / half) - (s * s_next) * before
        s = s_next
    return now


def _growth(value: float, low: float, high: float) -> float:
    """How much a degree magnifies ``value`` over the interval, as a logarithm."""
    return float(np.arccosh(max(1.0, (value - (high + low) / 2) / ((high - low) / 2))))


def leading(data: Centred, count: int = COMPONENTS, seed: int = 20240612) -> tuple[np.ndarray, np.ndarray, float]:
    """(eigenvalues falling, eigenvectors as columns, largest residual) of V, certified."""
    rng = np.random.default_rng(seed)
    want = min(count, data.dim)
    q = np.linalg.qr(rng.standard_normal((data.dim, min(data.dim, want + GUARD))))[0]
    low, worst = None, np.inf
    while True:
        vq = data.times(q)
        small = q.T @ vq
        e, turn = np.linalg.eigh((small + small.T) / 2)
        e, turn = e[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        off = vq - q * e
        before, worst = worst, float(np.linalg.norm(off[:, :want], axis=0).max())
        top = max(float(e[0]), 0.0)
        if worst <= EXACT * np.sqrt(data.dim) * top or (worst <= ENOUGH * top and worst > before / 2) or q.shape[1] == data.dim:
            signs = np.sign(q[np.abs(q).argmax(0), np.arange(q.shape[1])])
            return e[:want], (q * signs)[:, :want], worst
        if low is None:  # a random block sees the whole spectrum
            low = max(0.0, float(e[-1]) - float(np.linalg.norm(off, 2)))
        high = float(e[-1])
        if high <= low or top <= high * (1 + 1e-9):
            low = 0.0
        gain = _growth(float(e[want - 1]), low, high) if high > low else 0.0
        if gain < SLOW:
            more = rng.standard_normal((data.dim, min(data.dim, 2 * q.shape[1]) - q.shape[1]))
            q = np.linalg.qr(np.hstack([q, more]))[0]
            continue
        apart = _growth(top, low, high) - gain
        degree = int(np.clip(np.log(DRIFT) / max(apart, 1e-9), 2, DEGREE))
        q = np.linalg.qr(_filtered(data, q, vq, low, high, top, degree))[0]


def whitened(vectors: DataFrame, count: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: vec_id, component (from 1), n, deviation,
    whitened, explained, identity_error, residual (the largest, over the first eigenvalue)."""
    rows, dim = integral(vectors)
    data = Centred(rows, dim)
    e, basis, worst = leading(data, count) if data.n else (np.zeros(0), np.zeros((dim, 0)), 0.0)
    keep = e > FLAT * e[0] if len(e) else np.zeros(0, bool)
    e, basis = e[keep], basis[:, keep]
    k, n, whole, left, rest = len(e), data.n, data.whole, data.left, data.rest()
    to_white = basis / np.sqrt(e)

    def moments(x):
        z = x @ to_white
        return np.concatenate([[np.einsum("ij,ij->", x, x)], z.sum(0), (z.T @ z).ravel()])

    total = data.summed(moments, 1 + k + k * k) / max(n, 1)
    mean = total[1 : 1 + k]
    cov = total[1 + k :].reshape(k, k) - np.outer(mean, mean)
    error = float(np.abs(cov - np.eye(k)).max()) if k else 0.0
    explained = e / total[0] if k else e
    residual = worst / e[0] if k else 0.0

    def run(batches):
        for batch in batches:
            if not k:
                continue
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                x = matrix(part.column(1), dim) - whole
                z = (x - rest) @ to_white
                exact = _squares(x, left, n)
                each = lambda a: pa.array(np.repeat(a, k))
                ids = part.column(0).take(each(np.arange(len(x))))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(len(x) * k, n)),
                     exact.take(each(np.arange(len(x)))), pa.array(z.ravel()), pa.array(np.tile(explained, len(x))),
                     pa.array(np.full(len(x) * k, error)), pa.array(np.full(len(x) * k, residual))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "residual"])

    return rows.mapInArrow(run, "vec_id long, component int, n long, deviation long, whitened double, explained double, "
                                "identity_error double, residual double")


def _squares(x: np.ndarray, left: np.ndarray, n: int) -> pa.Array:
    """Sum of (n x - S)^2 of each row, exact (x less the whole part of the mean)."""
    if n * (float(np.abs(x).max()) + 1) * np.sqrt(x.shape[1]) < 3e9:
        return pa.array(((n * x - left) ** 2).sum(1))
    exact = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(r, left)) for r in x]
    return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())
