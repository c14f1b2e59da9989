"""Gated recurrent units in numpy: forward passes, backpropagation through time, Adam.

Symbols enter through a table of gate inputs (one row per symbol, an embedding
already multiplied by the input weights).  Gates are update, reset and candidate:
z, r = s(x + h U), n = tanh(x_n + r * (h U_n)), h' = n + z * (h - n).
Sequences are arrays (time, lane); a lane's state is zero before ``RESET`` symbols,
which the caller marks.
"""

from __future__ import annotations

import numpy as np

F32 = np.float32
#: Values the optimiser works on at a time: what a core's cache holds.
PIECE = 1 << 14


def init(symbols: int, hidden: int, rng: np.random.Generator) -> dict[str, np.ndarray]:
    return {"X": (rng.normal(size=(symbols, 3 * hidden)) * 0.3).astype(F32),
            "U": (rng.normal(size=(hidden, 3 * hidden)) / np.sqrt(hidden)).astype(F32)}


class Runner:
    """Steps without a record, in buffers of their own.  Each gate has its own
    contiguous table and weights, signed and scaled so that every gate is 1 / (1 +
    exp(.)), the candidate being 2 / (1 + exp(-2 a)) - 1 = tanh a."""

    def __init__(self, p: dict[str, np.ndarray], lanes: int):
        k = p["U"].shape[0]
        (self.zr, self.n), (self.zr_weights, self.n_weights) = ([x * F32(f) for x, f in zip(_gates(p[i], k), (-1, -2), strict=True)] for i in "XU")
        self.k, self.buffers = k, np.empty((6, lanes * k), F32)

    def step(self, ids: np.ndarray, h: np.ndarray) -> None:
        """Moves the state of the lanes on, in place."""
        lanes, k = len(h), self.k
        zr, more = (b.reshape(-1)[: 2 * lanes * k].reshape(2, lanes, k) for b in (self.buffers[:2], self.buffers[2:4]))
        n, x = (b[: lanes * k].reshape(lanes, k) for b in self.buffers[4:])
        with np.errstate(over="ignore"):
            np.matmul(h, self.zr_weights, out=zr)
            self.zr.take(ids, 1, out=more, mode="clip")
            zr += more
            np.exp(zr, out=zr)
            zr += F32(1)
            np.reciprocal(zr, out=zr)
            np.matmul(h, self.n_weights, out=n)
            n *= zr[1]
            self.n.take(ids, 0, out=x, mode="clip")
            n += x
            np.exp(n, out=n)
        n += F32(1)
        np.divide(F32(2), n, out=n)
        n -= F32(1)
        h -= n
        h *= zr[0]
        h += n


def sigmoid(x: np.ndarray) -> np.ndarray:
    return _sigmoid(np.array(x))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place; beyond the range of exp the value is 0."""
    with np.errstate(over="ignore"):
        np.negative(x, out=x)
        np.exp(x, out=x)
    x += F32(1)
    return np.reciprocal(x, out=x)


def _gates(m: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Columns of update and reset (gate, row, column) and those of the candidate, contiguous."""
    return np.stack([m[:, :k], m[:, k : 2 * k]]), np.ascontiguousarray(m[:, 2 * k :])


def gates(p: dict[str, np.ndarray]) -> tuple[tuple[np.ndarray, np.ndarray], ...]:
    """The table and the recurrent weights by gate, as ``forward`` takes them."""
    return tuple(_gates(p[i], p["U"].shape[0]) for i in "XU")


def forward(p: dict[str, np.ndarray], ids: np.ndarray, h: np.ndarray, reset: np.ndarray | None = None, by_gate: tuple | None = None) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
    """(states after every step, what backpropagation needs); ``by_gate`` is ``gates(p)``."""
    (steps, lanes), k, dtype = ids.shape, h.shape[1], np.result_type(h, p["U"])
    (xzr, xn), (uzr, un) = by_gate or gates(p)
    states, before, zr = np.empty((steps, lanes, k), F32), np.empty((steps + 1, lanes, k), dtype), np.empty((steps, 2, lanes, k), dtype)
    gn, n = (np.empty((steps, lanes, k), dtype) for _ in range(2))
    more, ids = np.empty((2, lanes, k), xzr.dtype), np.ascontiguousarray(ids, np.intp)
    before[0], some = h, np.zeros(steps, bool) if reset is None else reset.any(1)
    for t in range(steps):
        h, (z, r) = before[t], zr[t]
        if some[t]:
            h[reset[t]] = 0
        np.matmul(h, uzr, out=zr[t])
        np.matmul(h, un, out=gn[t])
        xzr.take(ids[t], 1, out=more, mode="clip")
        zr[t] += more
        _sigmoid(zr[t])
        np.multiply(r, gn[t], out=n[t])
        xn.take(ids[t], 0, out=more[0], mode="clip")
        n[t] += more[0]
        np.tanh(n[t], out=n[t])
        new = np.subtract(h, n[t], out=before[t + 1])
        new *= z
        new += n[t]
        states[t] = new
    return states, (before[:-1], zr, gn, n)


def backward(p: dict[str, np.ndarray], ids: np.ndarray, cache: tuple[np.ndarray, ...], dstates: np.ndarray, reset: np.ndarray | None = None, add=np.add.at) -> dict[str, np.ndarray]:
    """Gradients of the table and the recurrent weights, given those of every state;
    ``add`` adds rows to the table."""
    k, (before, every_zr, every_gn, every_n) = p["U"].shape[0], cache
    # of the candidate, update, reset and the candidate's recurrent part: the table's
    # gradients are the first three, the recurrent weights' the last three
    grads, dh = np.empty((*ids.shape, 4 * k), F32), np.zeros((ids.shape[1], k), F32)
    (d, f), e = (np.empty(dh.shape, F32) for _ in range(2)), np.empty((2, *dh.shape), F32)
    some = np.zeros(len(ids), bool) if reset is None else reset.any(1)
    for t in range(len(ids) - 1, -1, -1):
        h, zr, gn, n, g = before[t], every_zr[t], every_gn[t], every_n[t], grads[t]
        dh += dstates[t]
        np.subtract(1, zr, out=e)
        np.multiply(dh, e[0], out=d)
        e *= zr
        np.subtract(h, n, out=f)
        f *= dh
        np.multiply(f, e[0], out=g[:, k : 2 * k])
        np.multiply(n, n, out=f)
        np.subtract(1, f, out=f)
        d *= f  # of the candidate
        g[:, :k] = d
        np.multiply(d, gn, out=f)
        np.multiply(f, e[1], out=g[:, 2 * k : 3 * k])
        np.multiply(d, zr[1], out=g[:, 3 * k :])
        dh *= zr[0]
        dh += g[:, k:] @ p["U"].T
        if some[t]:
            dh[reset[t]] = 0
    table, flat = np.zeros_like(p["X"]), grads.reshape(-1, 4 * k)
    add(table, ids.ravel(), flat[:, : 3 * k])
    return {"X": np.roll(table, -k, 1), "U": before.reshape(-1, k).T @ flat[:, k:]}


class Adam:
    def __init__(self, params: dict[str, np.ndarray], rate: float):
        self.params, self.rate, self.t = params, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def update(self, grads: dict[str, np.ndarray], scale: float = 1.0, share: float = 1.0) -> None:
        """One step; gradients count by ``share``."""
        self.t += 1
        norm = share * np.sqrt(sum(float(np.vdot(g, g)) for g in grads.values()))
        cut = share * min(1.0, 5.0 / (norm + 1e-9))  # gradient clipping
        b = 1 - 0.999**self.t
        step = F32(self.rate * scale / (1 - 0.9**self.t))
        for k, g in grads.items():
            every = [x.reshape(-1) for x in (g, self.m[k], self.v[k], self.params[k])]
            one, two = np.empty((2, min(g.size, PIECE)), g.dtype)
            for i in range(0, g.size, PIECE):
                g, m, v, x = (y[i : i + PIECE] for y in every)
                a, c = one[: len(g)], two[: len(g)]
                np.multiply(g, F32(cut), out=a)
                m *= F32(0.9)
                np.multiply(a, F32(0.1), out=c)
                m += c
                a *= a
                a *= F32(0.001)
                v *= F32(0.999)
                v += a
                np.multiply(v, F32(1 / b), out=a)
                np.sqrt(a, out=a)
                a += F32(1e-8)
                np.divide(m, a, out=a)
                a *= step
                x -= a
