from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from cardpanel.llm import decision_list as D

from .odd import odd_documents, words


def brute(t):
    w = words(t)
    lines, seen, dups = (t or "").split("\n"), set(), 0
    for line in lines:
        if words(line):
            dups += line in seen
            seen.add(line)
    win = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    cover = {j for i, x in enumerate(win) if win.count(x) > 1 for j in range(i, i + 8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), dups, len(cover)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab é#|<\n \t", max_size=120)), min_size=1, max_size=5))
def test_statistics_equal_brute_force(texts):
    got = D.statistics(pa.array(texts, pa.string()))
    assert [tuple(int(got[k][i]) for k in D.BASE) for i in range(len(texts))] == [brute(t) for t in texts]


def test_learns_a_planted_list():
    rng = np.random.default_rng(0)
    x = rng.random((6000, len(D.FEATURES)))
    i, j, k = (D.FEATURES.index(f) for f in ("symbols_per_word", "upper_share", "bang_share"))
    bad = (x[:, i] > 0.8) | ((x[:, j] > 0.7) & (x[:, k] <= 0.3))
    rules = D.learned(x, bad ^ (rng.random(6000) < 0.02))
    said = np.zeros(6000, bool)
    for r in rules:
        said |= r.covers(x)
    assert (said == bad).mean() > 0.96 and all(len(r.conditions) <= D.CONDITIONS for r in rules)
    assert D.learned(x, np.ones(6000, bool)) == [] and D.learned(x[:0], bad[:0]) == []


def test_the_list_is_one_ordered_expression(spark):
    rules = [D.Rule((("symbols_per_word", True, 0.5),)), D.Rule((("n_words", False, 30.0), ("upper_share", True, 0.0)))]
    docs = spark.createDataFrame([(1, "a# " * 25), (2, "Aa " * 25), (3, "aa " * 25), (4, "aa b c d e f g h " * 25), (5, "x")], "doc_id long, text string")
    got = {r.doc_id: (r.rule, r.base_failed) for r in D.judged(docs, rules).collect()}
    assert got[1][0] == 1 and got[2][0] == 2 and got[3][0] is None and got[5] == (None, True) and got[4][1]


def test_odd_documents_and_labels(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (99, 0, 0), (None, 1, 1), (2, None, 1)], "doc_id long, quality int, toxic int")
    assert D.fit(docs, labels) == [] and D.fit(docs, labels.limit(0)) == []
    rows = D.judged(docs, []).collect()
    assert len(rows) == docs.count() and all(r.kept == (not r.base_failed) for r in rows)
    kept = D.filtered(docs, [])
    assert kept.columns == docs.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 2, 3]
    assert D.judged(docs.limit(0), []).count() == 0


def test_held_out_accuracy(spark):
    from cardpanel.llm.tables import read
    docs, labels = (read(spark, "/root/testdata/sf0.01", t) for t in ("documents", "labels"))
    rules = D.fit(docs, labels.filter("doc_id % 3 != 0"))
    got = D.judged(docs, rules).join(labels.filter("doc_id % 3 = 0"), "doc_id").filter("not base_failed")
    right = got.filter("kept = (quality = 1)").count()
    assert right >= 0.93 * got.count()


def test_rules_need_evidence():
    """A rule that few held-back rows confirm is not accepted, however pure."""
    assert D.least_share(1.0, 3) < D.PRECISION < D.least_share(1.0, 7) and D.least_share(1.0, 0) == 0.0
    rng = np.random.default_rng(3)
    x = rng.random((300, len(D.FEATURES)))
    few = np.zeros(300, bool)
    few[np.argsort(x[:, 0])[-9:]] = True
    assert D.learned(x, few) == []  # about three rows held back
    assert D.learned(x, x[:, 0] > 0.8)


def test_ids_of_any_type(spark):
    docs = spark.createDataFrame([(f"d{i}", f"word{i} " * (3 + i % 40)) for i in range(60)], "doc_id string, text string")
    labels = spark.createDataFrame([(f"d{i}", i % 2) for i in range(60)], "doc_id string, quality int")
    assert D.judged(docs, D.fit(docs, labels)).count() == 60
