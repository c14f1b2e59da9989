from __future__ import annotations

import numpy as np
import pytest

from cardpanel.llm import cover_tree as C

SCHEMA = "vec_id long, embedding array<double>, label int, grp string, v int, cls long, n_links string"


def frame(spark, rows):
    full = [(i, None if v is None else [None if c is None else float(c) for c in v], label, "g", 1, 2, None) for i, v, label in rows]
    return spark.createDataFrame(full, SCHEMA)


def brute(rows, threshold):
    """Number of links and least reachable id of every usable row, by all pairs."""
    group, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                if C.cosine(np.array(rows[a][1], float), np.array(rows[b][1], float)) >= threshold:
                    links[a] += 1
                    links[b] += 1
                    group[find(a)] = find(b)
    least = {}
    for i, r in enumerate(rows):
        least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return sorted((r[0], links[i], least[find(i)]) for i, r in enumerate(rows))


def clouds(seed, n=420, dim=6):
    """Tight clusters, wide ones with pairs round the threshold, chains, copies and scattered vectors."""
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((8, dim))
    out = []
    for i in range(n):
        k = i % 10
        if k < 8:
            v = base[k] + rng.standard_normal(dim) * (0.01, 0.02, 0.05, 0.1, 0.1, 0.2, 0.3, 0.5)[k]
        elif k == 8 and out:
            v = out[rng.integers(len(out))][1]
        else:
            v = rng.standard_normal(dim)
        out.append((int(i * 7 % 997), (np.asarray(v) * rng.choice([1.0, 3.0])).tolist(), int(rng.integers(2)) if k % 2 else 0))
    out += [(2000 + i, [np.cos(i / 12), np.sin(i / 12), 0, 0, 0, 0], 0) for i in range(40)]
    return out


def found(spark, rows, threshold=0.98):
    return sorted((r.vec_id, r.n_links, r.component_id) for r in C.near_vectors(frame(spark, rows), threshold).collect())


@pytest.mark.parametrize("seed,chunk,threshold", [(1, 1024, 0.98), (2, 24, 0.98), (3, 60, 0.9)])
def test_equals_all_pairs(spark, monkeypatch, seed, chunk, threshold):
    """One box a label; many boxes, centres and large tight nodes."""
    monkeypatch.setattr(C, "CHUNK", chunk)
    monkeypatch.setattr(C, "CENTERS", 60)
    monkeypatch.setattr(C, "LEAF", 4)
    rows = clouds(seed)
    assert found(spark, rows, threshold) == brute(rows, threshold)


@pytest.mark.parametrize("visit", [1, 200, 1_000_000])
def test_traversal_equals_dense_products(visit, monkeypatch):
    monkeypatch.setattr(C, "VISIT", visit)
    monkeypatch.setattr(C, "LEAF", 3)
    rng = np.random.default_rng(9)
    x = np.concatenate([rng.standard_normal((60, 5)), *(rng.standard_normal(5) + rng.standard_normal((80, 5)) * s for s in (0.02, 0.08, 0.2))])
    rng.shuffle(x)
    weight = rng.integers(1, 4, len(x))
    hit = C.unit(x) @ C.unit(x).T >= 0.98
    np.fill_diagonal(hit, False)
    whole = C.Links(x, weight, len(x), 0.98)
    whole.run()
    assert (np.rint(whole.count) == hit @ weight).all()
    assert ((whole.root[:, None] == whole.root) | ~hit).all()
    cut = C.Links(x, weight, 170, 0.98)
    cut.run()
    cross = hit.copy()
    cross[:170, :170] = cross[170:, 170:] = False
    assert (np.rint(cut.count) == cross @ weight).all()


def test_bounds_hold():
    rng = np.random.default_rng(4)
    x = C.unit(np.concatenate([rng.standard_normal((200, 8)), rng.standard_normal(8) + rng.standard_normal((200, 8)) * 0.1]))
    todo = [C.Node.root(x)]
    while todo:
        p = todo.pop()
        assert np.linalg.norm(x[p.members] - p.centre, axis=1).max() <= p.radius + 1e-9
        if not p.leaf:
            below = [p.child(i) for i in range(len(p.below()[0]))]
            assert sorted(np.concatenate([c.members for c in below])) == sorted(p.members)
            todo += below


def test_cosine_at_the_threshold(spark):
    rows = [(1, [1, 0], 0), (2, [0.98, (1 - 0.98**2) ** 0.5], 0), (3, [49, 9.95], 1), (4, [1, 0], 1), (5, [1e200, 0], 2), (6, [1e-200, 1e-201], 2)]
    assert found(spark, rows) == brute(rows, 0.98)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1, 0], 0), (2, [2, 0], 0), (2, [2, 0], 0), (None, [1, 0], 0), (3, [1, 0], None), (4, None, 0), (5, [0, 0], 0), (6, [nan, 1], 0),
            (7, [inf, 1], 0), (8, [None, 1], 0), (9, [], 0), (10, [1, 0, 0], 0), (11, [1, 0], 1), (12, [5, 0], 1), (None, [0, 1], 3)]
    out = C.near_vectors(frame(spark, rows))
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"]
    got = sorted(((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in out.collect()))
    assert got == sorted([(1, 3, 1, True), (2, 3, 1, False), (2, 3, 1, False), (0, 3, 1, False), *((i, 0, i, True) for i in range(3, 11)),
                          (11, 1, 11, True), (12, 1, 11, False), (0, 0, 0, True)])
    assert C.near_vectors(frame(spark, rows).limit(0)).count() == 0
