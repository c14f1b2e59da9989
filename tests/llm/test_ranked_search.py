from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from cardpanel.llm import ranked_search as R

from .odd import lower, odd_documents

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute(docs, items, k=R.TOP):
    counts = [(i, Counter(TERM.findall(lower(t)))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, length = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in counts:
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // length
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
                        for t in set(TERM.findall(lower(text))) if c[t])
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def corpus(n=700, seed=3):
    """Zipf-like words, copies, and documents about a few subjects."""
    rng = random.Random(seed)
    vocabulary = [f"t{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    docs = []
    for i in range(n):
        if docs and rng.random() < 0.1:
            docs.append((i * 5 % 1009, rng.choice(docs)[1]))
            continue
        subject = rng.randrange(20) * 15 + 60
        w = rng.choices(vocabulary, weights, k=rng.randrange(1, 60)) + [f"T{subject + rng.randrange(15)}" for _ in range(rng.randrange(12))]
        rng.shuffle(w)
        docs.append((i * 5 % 1009, ", ".join(w)))
    items = [(j, " ".join(rng.choices(vocabulary, weights, k=rng.randrange(1, 12)) + [f"t{rng.randrange(60, 380)}"])) for j in range(30)]
    return docs, items


def ranks(spark, docs, items, k=R.TOP):
    found = R.ranked(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), k)
    return sorted(map(tuple, found.collect()), key=str)


@pytest.mark.parametrize("settings", [{}, {"SHARD": 64, "BLOCK": 4, "CELLS": 1}, {"TERMS": 40, "WIDTH": 3, "BLOCK": 8}])
def test_equals_brute_force(spark, monkeypatch, settings):
    """One batch; small shards and blocks; several batches with summaries cut to three coordinates."""
    for name, value in settings.items():
        monkeypatch.setattr(R, name, value)
    docs, items = corpus()
    assert ranks(spark, docs, items) == brute(docs, items)


def test_few_best_with_ties(spark):
    docs = [(i, "alpha beta") for i in range(9, 0, -1)] + [(20, "alpha"), (None, "alpha beta"), (5, "alpha beta"), (21, "gamma")]
    items = [(1, "Alpha, ALPHA beta"), (2, "delta"), (None, "beta"), (1, "gamma")]
    assert ranks(spark, docs, items, 3) == brute(docs, items, 3)
    assert ranks(spark, docs, items) == brute(docs, items)


def shard(seed=1, n=300):
    rng = np.random.default_rng(seed)
    rows, term, tf = [], [], []
    for i in range(n):
        t = np.unique(rng.zipf(1.5, 30) % 80)
        rows.append(len(t))
        term.append(t)
        tf.append(rng.integers(1, 5, len(t)))
    items = [np.unique(rng.zipf(1.5, 8) % 80).astype(np.int32) for _ in range(12)]
    items = [x[np.isin(x, np.concatenate(term))] for x in items]
    near = near_terms(items, 80)
    ends = np.concatenate([[0], np.cumsum(rows)])
    df = np.bincount(np.concatenate(term), minlength=80)
    s = R.Statistics(n, int(ends[-1]), np.floor(1000 * np.log((2 * n + 2) / (2 * df + 1))).astype(np.int64))
    lengths = np.array([x.sum() for x in tf])
    x = R.build(pa.array(np.arange(n)), lengths, ends, np.concatenate(term), np.concatenate(tf), s, near)
    return x, R.Lists(x, near), items


def near_terms(items, n):
    """For each term those it shares an item with (itself, where none has it)."""
    out = [np.array([t], np.int32) for t in range(n)]
    used = np.unique(np.concatenate(items))
    for t, places in zip(used, R._near([np.searchsorted(used, x) for x in items], len(used))):
        out[t] = used[places].astype(np.int32)
    return out


def test_summaries_bound_every_document(monkeypatch):
    monkeypatch.setattr(R, "BLOCK", 16)
    x, lists, items = shard()
    table = np.zeros((len(x.ends) - 1, 80))
    rows = np.repeat(np.arange(len(x.ends) - 1), np.diff(x.ends))
    table[rows, x.term] = x.impact
    blocks = 0
    for i, t in enumerate(x.lists):
        members = []
        for b in range(x.first[i], x.first[i + 1]):
            docs = x.docs[x.block[b] : x.block[b + 1]]
            exact = table[docs][:, lists.near[t]].max(0)
            assert (lists.summary(i)[b - x.first[i]] >= exact).all() and np.allclose(lists.summary(i)[b - x.first[i]], exact, rtol=1e-6)
            members += docs.tolist()
            blocks += 1
        assert sorted(members) == np.flatnonzero(table[:, t]).tolist()
    assert blocks > len(x.lists)


def test_blocks_are_skipped_and_none_in_error(monkeypatch):
    monkeypatch.setattr(R, "BLOCK", 16)
    x, lists, items = shard()
    scored = []
    whole = R.Lists.scores
    monkeypatch.setattr(R.Lists, "scores", lambda self, docs: scored.append(len(docs)) or whole(self, docs))
    table = np.zeros((len(x.ends) - 1, 80))
    table[np.repeat(np.arange(len(x.ends) - 1), np.diff(x.ends)), x.term] = x.impact
    for item in items:
        total = table[:, item].sum(1)
        least = int(np.sort(total)[-3])
        docs, scores = R.visit(x, lists, item, max(least, 1), 10)
        assert sorted(docs) == sorted(np.flatnonzero(total >= max(least, 1))[:10]) or len(docs) == 10
        assert (scores == total[docs]).all()
    assert sum(scored) < 0.7 * sum((table[:, item].sum(1) > 0).sum() for item in items)


def test_odd_documents(spark):
    docs = odd_documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    items = spark.createDataFrame([(1, "W1 w2 extra", 3), (2, None, 3), (3, "", 3), (4, "long " * 50_000, 3), (5, "été MER", 3), (6, "!!! ???", 3)],
                                  "item_id long, text string, score int")
    got = R.ranked(docs, items)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, [(r.item_id, r.text) for r in items.collect()])
    assert R.ranked(docs.limit(0), items).count() == 0 and R.ranked(docs, items.limit(0)).count() == 0


def test_summaries_leave_out_terms_that_no_document_of_the_shard_has():
    near = [np.arange(80, dtype=np.int32) for _ in range(80)]  # all terms share an item
    term, ends = np.array([3, 7, 9, 3, 9, 3]), np.array([0, 3, 5, 6])
    s = R.Statistics(1000, 100_000, np.full(80, 5000))
    x = R.build(pa.array([1, 2, 3]), np.array([3, 2, 1]), ends, term, np.ones(6, np.int32), s, near)
    lists = R.Lists(x, near)
    assert len(x.summary) == 3 * 3 and all(n.tolist() == [3, 7, 9] for n in lists.near.values())
    docs, scores = R.visit(x, lists, np.array([3, 9, 50], np.int32), 1, 10)
    table = np.zeros((3, 80), np.int64)
    table[np.repeat(np.arange(3), np.diff(x.ends)), x.term] = x.impact
    assert dict(zip(docs.tolist(), scores.tolist())) == dict(enumerate(table[:, [3, 9, 50]].sum(1).tolist()))
