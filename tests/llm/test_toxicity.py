from __future__ import annotations

import math
import re

import numpy as np

from cardpanel.llm import toxicity as X

from .odd import lower, odd_documents


def test_label_model_finds_accuracies_and_correlations():
    rng = np.random.default_rng(0)
    y = rng.random(4000) < 0.3

    def voter(accuracy, cover):
        said = np.where(rng.random(4000) < accuracy, y, ~y)
        return np.where(rng.random(4000) < cover, np.where(said, 1, -1), 0)

    good, fair, copy = voter(0.95, 0.8), voter(0.75, 0.9), voter(0.75, 0.9)
    v = np.column_stack([good, fair, copy, copy, copy, copy]).astype(np.int8)
    model = X.fit_label_model(v, np.where(good == 1, 0.9, np.where(good == -1, 0.1, 0.5)))
    p = model.posterior(v)
    assert ((p > 0.5) == y).mean() > 0.88 and abs(model.prior - 0.3) < 0.08
    assert model.weight[2:].max() < 0.4 < model.weight[0]  # copies share one voice
    assert model.chance[1, 0, 2] > model.chance[0, 0, 2]


def test_scores_on_held_out_rows(spark):
    from cardpanel.llm.tables import read
    docs, labels = (read(spark, "/root/testdata/sf0.01", t) for t in ("documents", "labels"))
    rows = X.toxicity(docs, labels).join(labels.select("doc_id", "toxic"), "doc_id").collect()
    for held in (True, False):
        part = [r for r in rows if r.held_out == held]
        caught = [r.predicted for r in part if r.toxic == 1]
        false = [r.predicted for r in part if r.toxic == 0]
        assert sum(caught) >= 0.5 * len(caught) and sum(false) <= 0.02 * len(false)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_labels_of_held_out_rows_and_other_columns_do_not_count(spark):
    from pyspark.sql import functions as F

    from cardpanel.llm.tables import fold_of, read
    docs, labels = (read(spark, "/root/testdata/sf0.001", t) for t in ("documents", "labels"))
    want = {r.doc_id: round(r.score, 9) for r in X.toxicity(docs, labels).collect()}
    turned = labels.withColumn("toxic", F.when(fold_of("doc_id", 4) == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    bare = docs.withColumns({"lang": F.lit(None).cast("string"), "source": F.lit("x")})
    assert {r.doc_id: round(r.score, 9) for r in X.toxicity(bare, turned).collect()} == want


def test_odd_documents(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(1, 0), (1, 1), (7, 1), (8, 0), (None, 1), (2, None), (55, 1)], "doc_id long, toxic int")
    rows = X.toxicity(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    for none in (labels.limit(0), labels.filter("toxic = 0")):
        assert {r.predicted for r in X.toxicity(docs, none).collect()} == {0}
    assert X.toxicity(docs.limit(0), labels).count() == 0


def test_lexicons_come_from_all_labelled_rows_and_insults_count(spark):
    n = 1200
    bad = lambda i: i % 10 == 0
    rows = [(i, f"text number n{i} of words " + (f"zork{'abcdefghij'[i // 10 % 10]} blah" if bad(i) else "is fine")) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(bad(i))) for i in range(n)], "doc_id long, toxic int")
    for sample in (n, 300):
        model = X.fit(docs, labels, X.F.lit(True), sample)
        words = X.words(np.frombuffer(b"zorka zorkj", np.uint8), np.array([0, 11]), X.NON_ALNUM, X.LOWER).hash
        assert np.isin(words, model.lexicon.hash).all()
    calm, rude = (b"you are a fine one", b"you are a fine idiot")
    model.dense[4] = 2.0
    text = np.frombuffer(calm + rude, np.uint8)
    scores = model.scores(X.words(text, np.array([0, len(calm), len(text)]), X.NON_ALNUM, X.LOWER))
    assert scores[1] > scores[0]


def test_labels_only_anchor_the_label_model():
    """Voters on unlabelled documents decide: a few wrong labels don't turn them round."""
    rng = np.random.default_rng(1)
    y = rng.random(5000) < 0.2
    v = np.column_stack([np.where(rng.random(5000) < c, np.where(rng.random(5000) < a, y, ~y) * 2 - 1, 0) for a, c in ((0.95, 0.7), (0.9, 0.8), (0.8, 0.9), (0.85, 0.6))]).astype(np.int8)
    gold = np.full(5000, np.nan)
    gold[:200] = np.where(rng.random(200) < 0.1, ~y[:200], y[:200])
    p = X.anchored(v, gold).posterior(v)
    assert ((p > 0.5) == y).mean() > 0.94
    gold[:200] = y[:200]
    assert ((X.anchored(v, gold).posterior(v) > 0.5) == y).mean() > 0.94


def _hash(word, kind):
    """Hash of an entry by itself: a word, or a stem as the words of its own length give it."""
    raw = np.frombuffer(word.encode(), np.uint8)
    h = X.hashes(raw, np.array([0]), np.array([len(raw)]), X.LOWER)[0]
    return int(h) if kind == 0 else int(h) ^ (0xA5A5_0000_0000_0001 * kind & ((1 << 64) - 1))


def test_scores_equal_a_plain_sum(spark):
    """Every text's score again in plain Python: entries, densities, insults."""
    from cardpanel.llm.tables import read
    docs, labels = (read(spark, "/root/testdata/sf0.001", t) for t in ("documents", "labels"))
    model = X.fit(docs, labels, X.F.lit(True))
    weight = {int(h): (float(model.entry[i])) for i, h in enumerate(model.lexicon.hash)}
    assert weight
    got = {r.doc_id: r.score for r in X.scored(docs, model).collect()}
    for r in docs.select("doc_id", "text").collect():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(r.text))
        found = [_hash(w, 0) for w in words]
        for kind, n in enumerate(X.STEMS, 1):
            found += [_hash(w[:n], kind) for w in words if len(w) > n]
        found = [h for h in found if h in weight]
        different, insults = len(set(found)), sum(w in X.INSULTS for w in words)
        dense = [math.log1p(different), min(different, 3), math.log1p(100 * len(found) / max(len(words), 1)), different == 0, min(insults, 3)]
        z = model.intercept + sum(weight[h] for h in set(found)) + sum(a * b for a, b in zip(dense, model.dense))
        assert abs(got[r.doc_id] - 1 / (1 + math.exp(-max(-30, min(30, z))))) < 1e-9
