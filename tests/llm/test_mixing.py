from __future__ import annotations

import numpy as np
import pytest

from cardpanel.llm import mixing as M

from .odd import odd_documents, words


def brute_targets(size):
    """Resharing the excess by weight until no target is above its cap."""
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    capped = {}
    while True:
        left, open_ = sum(size.values()) - sum(capped.values()), [s for s in names if s not in capped]
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * size[s]]
        if not over:
            return share | capped
        capped |= {s: 3.0 * size[s] for s in over}


def test_permutation_is_one(spark):
    for n in (1, 2, 3, 17, 1000):
        assert sorted(M.permuted(np.arange(n), n, 42)) == list(range(n))
    assert (M.permuted(np.arange(1000), 1000, 1) != M.permuted(np.arange(1000), 1000, 2)).any()


def test_draws_end_on_quotas():
    slots = np.array([0, 5, 100, 1, 10_000])
    counts = M.draws(slots, 16, 3)
    assert (counts.sum(0) == slots).all() and np.ptp(counts.sum(1)) <= 1 + slots.sum() % 16
    assert (counts == M.draws(slots, 16, 3)).all()


def test_mix_meets_targets_and_limits(spark):
    rng = np.random.default_rng(0)
    rows = [(i, " ".join(["w"] * int(rng.integers(0, 200))), ["a", "b", None, "zz", "c"][min(int(rng.integers(0, 12)), 4)]) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = M.mix_sources(docs).toPandas()
    again = M.mix_sources(docs.repartition(7)).toPandas()
    assert got.sort_values("doc_id").values.tolist() == again.sort_values("doc_id").values.tolist()
    size = {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + len(words(t))
    want = brute_targets(size)
    source = {i: s for i, _, s in rows}
    got["source"] = [source[i] for i in got.doc_id]
    assert (got.taken <= 3 * got["size"]).all()
    for s, part in got.groupby("source", dropna=False):
        s = None if s != s or s is None else s
        assert part["size"].sum() == size[s] == part.source_size.iloc[0]
        assert part.target.iloc[0] == pytest.approx(want[s])
        assert abs(part.taken.sum() - want[s]) <= M.BLOCK_WORDS


def test_blocks_hold_the_words_taken(spark):
    docs = spark.createDataFrame([(i, " ".join(f"d{i}w{k}" for k in range(50))) for i in range(30)], "doc_id long, text string").selectExpr(
        "doc_id", "text", "concat('s', doc_id % 3) as source")
    taken = {r.doc_id: r.taken for r in M.mix_sources(docs, block_words=16, shards=4).collect()}
    seen = {}
    for r in M.mixed_blocks(docs, block_words=16, shards=4).collect():
        for w in r.text.split():
            i = int(w[1:w.index("w")])
            seen[i] = seen.get(i, 0) + 1
    assert seen == {k: v for k, v in taken.items() if v}


def test_odd_documents(spark):
    docs = odd_documents(spark)
    got = M.mix_sources(docs).collect()
    assert len(got) == docs.count()
    assert all(r.taken <= 3 * r["size"] and r.target <= 3 * r.source_size for r in got)
    assert M.mix_sources(docs.limit(0)).count() == 0
    assert [tuple(r)[1:] for r in M.mix_sources(docs.filter("doc_id = 4")).collect()] == [(0, 0, 0.0, 0)]
