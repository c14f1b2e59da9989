"""Exact Shapley attributions of a boosted-tree model (path-dependent form).

The value of a feature coalition S for one tree is the tree output expected
when the features outside S are unknown: at a split on a feature in S the row
follows its own branch, otherwise both branches are averaged with the
training cover (weighted count) of each child.  Shapley values are then exact
sums over the coalitions of the features the tree actually splits on (the
other features are dummies with value 0), and add up over trees with the
tree weights.  Invariant: base + sum of attributions = model margin.

A tree's value is a sum over its leaves, and a leaf's part depends on a row only through
which of the features on its path let the row through: at most 2^d patterns for d such
features.  So each leaf has a table of attributions by pattern, and a row looks up one
entry a leaf.  The weights of the coalitions are an integral over [0, 1] of a polynomial,
taken exactly by Gauss-Legendre nodes.

Distribution: the node table (trees x nodes, bounded by the model's size
parameters, not by the data) is read from the saved model in the shared
checkpoint folder and shipped to the executors; rows are explained in
``mapInPandas`` batches, some ``ROWS`` for each table and ``CHUNK`` at a time, so memory
stays bounded whatever the partition size.
"""

from __future__ import annotations

import os
import uuid
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardpanel.schema import FEATURES
from cardpanel.session import checkpoint_dir, ship_package

CHUNK, ROWS = 128, 50_000


def node_table(model) -> tuple[pd.DataFrame, list[float]]:
    """(treeID, id, value, cover, left, right, feature, threshold) and the tree
    weights, read back from the model saved under the checkpoint folder."""
    spark = SparkSession.getActiveSession()
    path = os.path.join(checkpoint_dir(spark), f"model-{uuid.uuid4().hex}")
    model.write().overwrite().save(path)
    nodes = spark.read.parquet(os.path.join(path, "data")).select(
        "treeID", F.col("nodeData.id").alias("id"), F.col("nodeData.prediction").alias("value"),
        F.col("nodeData.impurityStats")[0].alias("cover"), F.col("nodeData.leftChild").alias("left"),
        F.col("nodeData.rightChild").alias("right"), F.col("nodeData.split.featureIndex").alias("feature"),
        F.get(F.col("nodeData.split.leftCategoriesOrThreshold"), 0).alias("threshold"))
    return nodes.toPandas(), list(model.treeWeights)


def _trees(nodes: pd.DataFrame):
    out = []
    for tid, t in nodes.groupby("treeID"):
        columns = (t[c].to_numpy() for c in ("id", "left", "right", "feature", "threshold", "value", "cover"))
        out.append((int(tid), {int(i): (int(l), int(r), int(f), float(thr) if l >= 0 else 0.0, float(v), float(c))
                               for i, l, r, f, thr, v, c in zip(*columns)}))
    return sorted(out)


def _tree_values(tree: dict, x: np.ndarray):
    """V[row, S] for every coalition S of the tree's split features U: the definition, which tests compare with."""
    feats = sorted({f for (l, _, f, _, _, _) in tree.values() if l >= 0})
    u = len(feats)
    pos = {f: k for k, f in enumerate(feats)}
    subsets = np.arange(1 << u)

    def ev(i):
        left, right, f, thr, value, _ = tree[i]
        if left < 0:
            return np.full((x.shape[0], 1 << u), value)
        lv, rv = ev(left), ev(right)
        cl, cr = tree[left][5], tree[right][5]
        total = cl + cr
        avg = (cl * lv + cr * rv) / total if total > 0 else 0.5 * (lv + rv)
        routed = np.where((x[:, f] <= thr)[:, None], lv, rv)
        in_s = ((subsets >> pos[f]) & 1).astype(bool)
        return np.where(in_s[None, :], routed, avg)

    return feats, ev(0)


class Leaves(NamedTuple):
    """Leaves of a tree: values; by (leaf, feature) the first and last bin that lead there, the
    cover share that the feature's splits let through, and whether it has any."""

    value: np.ndarray
    first: np.ndarray
    last: np.ndarray
    share: np.ndarray
    used: np.ndarray


def _leaves(tree: dict, cuts: list[np.ndarray]) -> Leaves:
    m, out = len(cuts), []
    todo = [(0, [0] * m, [len(c) for c in cuts], [1.0] * m, [False] * m)]
    while todo:
        i, first, last, share, used = todo.pop()
        left, right, f, thr, value, _ = tree[i]
        if left < 0:
            out.append((value, first, last, share, used))
            continue
        k, total = int(np.searchsorted(cuts[f], thr)), tree[left][5] + tree[right][5]
        on = [*used[:f], True, *used[f + 1:]]
        for child in (left, right):
            part = tree[child][5] / total if total > 0 else 0.5
            a, b = (first[f], min(last[f], k)) if child == left else (max(first[f], k + 1), last[f])
            todo.append((child, [*first[:f], a, *first[f + 1:]], [*last[:f], b, *last[f + 1:]], [*share[:f], share[f] * part, *share[f + 1:]], on))
    return Leaves(*(np.array([x[k] for x in out]).reshape(len(out), *([m] if k else [])) for k in range(5)))


def _prepared(trees, m: int) -> tuple[list[np.ndarray], list[Leaves]]:
    """Thresholds of each feature over all trees, and the leaves of each tree."""
    cuts = [np.unique([thr for _, tree in trees for left, _, f, thr, _, _ in tree.values() if left >= 0 and f == k]) for k in range(m)]
    return cuts, [_leaves(tree, cuts) for _, tree in trees]


def _table(leaves: Leaves) -> tuple[np.ndarray, np.ndarray]:
    """(pattern of a leaf, feature), with the leaf's part of the tree's output at last, and where each leaf's patterns begin."""
    d = leaves.used.sum(1)
    start, m = np.concatenate([[0], (1 << d).cumsum()]), leaves.used.shape[1]
    table = np.zeros((start[-1], m + 1))
    table[start[1:] - 1, m] = leaves.value  # every feature lets the row through
    for n in np.unique(d[d > 0]).tolist():
        at = np.flatnonzero(d == n)
        features = np.nonzero(leaves.used[at])[1].reshape(-1, n)
        z = np.take_along_axis(leaves.share[at], features, 1)[:, None]
        o = (np.arange(1 << n)[:, None] >> np.arange(n)) & 1
        nodes, weights = np.polynomial.legendre.leggauss((n + 1) // 2)
        psi = np.zeros((len(at), 1 << n, n))
        for t, w in zip((nodes + 1) / 2, weights / 2):
            factor = z * (1 - t) + o * t
            others = np.full(factor.shape, w)
            others[..., 1:] *= factor[..., :-1].cumprod(-1)
            others[..., :-1] *= factor[..., :0:-1].cumprod(-1)[..., ::-1]
            psi += others
        rows = start[at][:, None] + np.arange(1 << n)
        table[rows[:, :, None], features[:, None]] = leaves.value[at][:, None, None] * (o - z) * psi
    return table, start[:-1]


def _explained(prepared: tuple[list[np.ndarray], list[Leaves]], weights, x: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
    cuts, trees = prepared
    m, out, base = x.shape[1], np.zeros((len(x), x.shape[1] + 1)), 0.0
    bins = [np.searchsorted(c, column) for c, column in zip(cuts, x.T)]
    for leaves, weight in zip(trees, weights):
        table, start = _table(leaves)
        table *= weight
        base += weight * float((leaves.value * np.where(leaves.used, leaves.share, 1.0).prod(1)).sum())
        bit = np.where(leaves.used, 1 << (leaves.used.cumsum(1) - 1), 0)
        codes = []
        for f in np.flatnonzero(leaves.used.any(0)):
            at = np.arange(len(cuts[f]) + 1)[:, None]
            codes.append((bins[f], np.where((at >= leaves.first[:, f]) & (at <= leaves.last[:, f]), bit[:, f], 0)))
        for lo in range(0, len(x), CHUNK):
            s = slice(lo, lo + CHUNK)
            entry = np.repeat(start[None], len(out[s]), 0)
            for at, code in codes:
                entry += code.take(at[s], axis=0)
            out[s] += table.take(entry, axis=0).sum(1)
    return out[:, :m], base, out[:, m].copy()


def explain_matrix(trees, weights, x: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
    """(attributions n x m, base value, margin n) on the model's margin scale."""
    return _explained(_prepared(trees, x.shape[1]), weights, x)


def tree_attributions(df: DataFrame, model, names=FEATURES, key: str = "customer_id",
                      scale: str = "margin") -> DataFrame:
    """key + one attribution column per feature + base_value + margin.

    ``scale="margin"``: the ensemble's raw score (sum of weighted trees);
    ``scale="log_odds"``: twice that, the log-odds of P(default) for Spark's
    boosted classifier (probability = 1 / (1 + exp(-2 margin)))."""
    factor = {"margin": 1.0, "log_odds": 2.0}[scale]
    ship_package(df.sparkSession)
    nodes, weights = node_table(model)
    names = list(names)
    prepared = _prepared(_trees(nodes), len(names))
    sc = df.sparkSession.sparkContext
    shared = sc.broadcast((prepared, weights))
    schema = f"{key} long, " + ", ".join(f"{n} double" for n in names) + ", base_value double, margin double"

    def explained(some: list[pd.DataFrame]) -> pd.DataFrame:
        part = pd.concat(some)
        phi, base, margin = _explained(*shared.value, part[names].to_numpy(dtype=float))
        out = pd.DataFrame(phi * factor, columns=names)
        out.insert(0, key, part[key].to_numpy())
        out["base_value"], out["margin"] = base * factor, margin * factor
        return out

    def run(batches):
        some = []
        for pdf in batches:
            some.append(pdf)
            if sum(map(len, some)) >= ROWS:
                yield explained(some)
                some = []
        if some:
            yield explained(some)

    return df.select(key, *[F.col(n).cast("double") for n in names]).mapInPandas(run, schema)
