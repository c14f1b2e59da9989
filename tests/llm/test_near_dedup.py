from __future__ import annotations

import random

import numpy as np

from cardpanel.llm import near_dedup as N
from cardpanel.llm.graph import components

from .odd import lower, odd_documents, words


def brute(docs, k, percent=80):
    sets = []
    for _, t in docs:
        w = words(lower(t))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    group = list(range(len(docs)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                group[find(a)] = find(b)
    members = {}
    for i in range(len(docs)):
        members.setdefault(find(i), []).append(docs[i][0])
    return {docs[i][0]: (len(sets[i]), min(members[find(i)])) for i in range(len(docs))}


def corpus(n=260, seed=5):
    """Chains and clouds of near copies round the threshold, copies, shared passages."""
    rng = random.Random(seed)
    word = lambda: f"v{rng.randrange(4000)}"
    passage = [word() for _ in range(60)]
    docs, bases = [], [[word() for _ in range(rng.choice([8, 60, 150]))] for _ in range(12)]
    for i in range(n):
        w = list(rng.choice(bases[: 3 if i % 2 else 12]))
        for _ in range(rng.randrange(0, max(2, len(w) // 12))):
            w[rng.randrange(len(w))] = word()
        docs.append((i * 3 % 1009, " ".join(w if rng.random() < 0.8 else passage + w[:20])))
    return docs


def test_equals_brute_force(spark):
    docs = corpus()
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for k in (4, 5):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.near_duplicates(frame, k).collect()}
        assert got == brute(docs, k)


def test_small_blocks_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 4)
    docs = corpus(120, 6)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), 4).collect()}
    assert got == brute(docs, 4)


def test_sequential_test_keeps_similar_pairs():
    rng = np.random.default_rng(1)
    left = rng.integers(0, 1 << 16, (4000, N.HASHES)).astype(np.uint16)
    right = np.where(rng.random(left.shape) < 0.82, left, rng.integers(0, 1 << 16, left.shape)).astype(np.uint16)
    each, need = np.arange(len(left)), N.least_agreements(0.8)
    assert len(N.alive(left, right, each, each, need)) == len(left)
    low = np.where(rng.random(left.shape) < 0.5, left, 0).astype(np.uint16)
    assert len(N.alive(left, low, each, each, need)) == 0


def test_minima_estimate_similarity():
    rng = np.random.default_rng(2)
    a = np.unique(rng.integers(0, 1 << 63, 900).astype(np.uint64))
    b = np.concatenate([a[:700], rng.integers(0, 1 << 63, 200).astype(np.uint64)])
    m = N.minima([a, np.unique(b)])
    assert abs((m[0] == m[1]).mean() - 700 / 1100) < 0.1


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(50)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_documents(spark):
    docs = odd_documents(spark)
    rows = N.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    got = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in rows}
    assert got[1, 36] == (1, True) and got[2, 36] == (1, False) and got[3, 37] == (1, False) and got[None, 36] == (1, False)
    assert got[4, 0] == (4, True) and got[6, 0] == (6, True) and got[7, 1] == (7, True)
    kept = N.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4, 5, 6, 7, 7, 8, 9, 10]
    assert N.near_duplicates(docs.limit(0)).count() == 0 and N.one_of_each(docs.limit(0)).count() == 0
