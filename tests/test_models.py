from __future__ import annotations

import itertools
import random
from math import factorial

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cardpanel.operators import modeling as md
from cardpanel.operators.treeshap import _trees, _tree_values, explain_matrix, node_table, tree_attributions
from cardpanel.plans.portfolio import PortfolioPlan
from tests.conftest import SF01

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def small_gbt(spark):
    rnd = random.Random(5)
    rows = [(i, rnd.random(), rnd.random(), rnd.random()) for i in range(300)]
    rows = [(i, a, b, c, float((a + b * c + 0.2 * rnd.random()) > 0.8)) for i, a, b, c in rows]
    df = spark.createDataFrame(rows, "customer_id long, a double, b double, c double, y double")
    d = VectorAssembler(inputCols=NAMES, outputCol="features").transform(df)
    model = GBTClassifier(labelCol="y", maxIter=5, maxDepth=3, seed=1).fit(d)
    return df, d, model


def test_tree_attributions_additive(spark, small_gbt):
    df, d, model = small_gbt
    attr = tree_attributions(df, model, NAMES).toPandas().set_index("customer_id").sort_index()
    raw = model.transform(d).select("customer_id", vector_to_array("rawPrediction")[1].alias("m")).toPandas()
    raw = raw.set_index("customer_id").sort_index()
    total = attr["base_value"] + attr[NAMES].sum(axis=1)
    assert np.allclose(total.to_numpy(), attr["margin"].to_numpy(), atol=1e-9)
    assert np.allclose(attr["margin"].to_numpy(), raw["m"].to_numpy(), atol=1e-9)


def test_tree_attributions_match_permutation_definition(spark, small_gbt):
    df, _, model = small_gbt
    nodes, weights = node_table(model)
    trees = _trees(nodes)
    x = df.select(*NAMES).limit(3).toPandas().to_numpy()
    phi, _, _ = explain_matrix(trees, weights, x)

    def value(row, s):  # expected ensemble output knowing only features in s
        total = 0.0
        for (tid, tree), w in zip(trees, weights):
            feats, v = _tree_values(tree, row[None, :])
            idx = sum(1 << k for k, f in enumerate(feats) if f in s)
            total += w * v[0, idx]
        return total

    for r in range(3):
        for i in range(3):
            exp = 0.0
            for perm in itertools.permutations(range(3)):
                before = set(perm[:perm.index(i)])
                exp += value(x[r], before | {i}) - value(x[r], before)
            assert phi[r, i] == pytest.approx(exp / factorial(3), abs=1e-12)


def test_deep_trees_are_explained_from_their_leaves():
    """2,000 rows by 40 trees of depth 7: by coalitions at every node a quarter of a minute."""
    import time
    rng = np.random.default_rng(4)

    def grown(depth):
        tree = {}

        def node(levels):
            i = tree[len(tree)] = len(tree)
            if not levels or rng.random() < 0.03:
                tree[i] = (-1, -1, -1, 0.0, rng.normal(), rng.random())
            else:
                f, threshold, left, right = int(rng.integers(8)), float(rng.integers(31)), node(levels - 1), node(levels - 1)
                tree[i] = (left, right, f, threshold, 0.0, tree[left][5] + tree[right][5])
            return i

        node(depth)
        return tree

    trees, weights = [(t, grown(7)) for t in range(40)], [1.0] + [0.1] * 39
    x = rng.integers(0, 32, (2000, 8)).astype(float)
    began = time.process_time()
    phi, base, margin = explain_matrix(trees, weights, x)
    assert time.process_time() - began < 5
    assert np.allclose(base + phi.sum(1), margin, atol=1e-12)
    want = np.zeros((5, 8))
    for (_, tree), w in zip(trees, weights):
        feats, v = _tree_values(tree, x[:5])
        for s in range(1 << len(feats)):
            n, u = bin(s).count("1"), len(feats)
            for k, f in enumerate(feats):
                if not s >> k & 1:
                    want[:, f] += w * (v[:, s | 1 << k] - v[:, s]) * factorial(n) * factorial(u - n - 1) / factorial(u)
    assert np.allclose(phi[:5], want, atol=1e-12)


def test_split_shares_and_folds(spark):
    p = PortfolioPlan(spark, SF01)
    d = md.with_folds(md.stratified_split(p.features.join(p.outcomes, "customer_id")), k=3)
    g = {(r["default_next_month"], r["split"]): r["count"] for r in d.groupBy("default_next_month", "split").count().collect()}
    for y in (0, 1):
        n = g[(y, "test")] + g[(y, "train")]
        assert g[(y, "test")] == round(0.2 * n + 1e-9)
    sizes = [r["count"] for r in d.groupBy("fold").count().collect()]
    assert max(sizes) - min(sizes) <= 2
    assert md.sample_n(p.features, 100).count() == 100


@pytest.mark.parametrize("per_bucket", [7, 50_000])
def test_ranks_by_histogram(spark, monkeypatch, per_bucket):
    """Many buckets and one give the ranks of a plain sort; classes of one row, empty shares, null labels."""
    monkeypatch.setattr(md, "BUCKET_ROWS", per_bucket)
    rows = [(i * 37, None if i % 50 == 0 else 2 if i == 3 else int(i % 5 == 0)) for i in range(600)]
    df = spark.createDataFrame(rows, "customer_id long, y int")

    def h(key, seed=42):
        x = (key % md.HASH_MOD * md.HASH_LCG + seed * md.HASH_SEED_MUL) % md.HASH_MOD
        return ((x ^ (x >> md.HASH_SHIFT)) * md.HASH_MUL) % md.HASH_MOD

    want = {}
    for y in (0, 1, 2):
        keys = sorted((k for k, v in rows if v == y), key=lambda k: (h(k), k))
        want |= {k: ("test" if r < round(0.3 * len(keys)) else "train", r % 4) for r, k in enumerate(keys)}
    split = {r.customer_id: r.split for r in md.stratified_split(df, "y", 0.3).collect()}
    folds = {r.customer_id: r.fold for r in md.with_folds(df, "y", 4).collect()}
    both = {r.customer_id: (r.split, r.fold) for r in md.split_and_folds(df, "y", 0.3, 4).collect()}
    assert both == want and split == {k: s for k, (s, _) in want.items()} and folds == {k: f for k, (_, f) in want.items()}
    assert set(md.stratified_split(df, "y", 0.0).select("split").distinct().toPandas()["split"]) == {"train"}


def test_standardize_population(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 3.0), (3, 5.0)], "customer_id long, a double")
    z = [r["a"] for r in md.standardize(df, ["a"]).orderBy("customer_id").collect()]
    assert z == pytest.approx([-1.224744871, 0.0, 1.224744871])


def test_exact_knn_matches_brute_force(spark):
    from cardpanel.operators.neighbors import exact_knn
    rng = np.random.default_rng(3)
    pts = np.vstack([rng.normal(0, 1, (150, 3)), rng.normal(5, 0.01, (80, 3)), np.ones((30, 3))])
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(pts)], "id long, a double, b double, c double")
    got = exact_knn(df, "id", NAMES, k=5, block_size=16).toPandas()
    d = np.sqrt(((pts[:, None, :] - pts[None, :, :]) ** 2).sum(axis=2))
    np.fill_diagonal(d, np.inf)
    for i in range(len(pts)):
        exp = np.sort(d[i])[:5]
        mine = np.sort(got.loc[got["pid"] == i, "distance"].to_numpy())
        assert np.allclose(mine, exp), i


def _frame_of(spark, x):
    names = [f"f{i}" for i in range(x.shape[1])]
    return spark.createDataFrame(pd.DataFrame(x, columns=names).assign(id=np.arange(len(x)) * 3)), names


def _clouds():
    rng = np.random.default_rng(8)
    heavy = np.column_stack([rng.lognormal(8, 2, 3000), rng.normal(0, 1, (3000, 4)), rng.integers(0, 7, (3000, 3))])
    ties = np.vstack([np.ones((1000, 4)), rng.normal(0, 1, (2000, 4))])
    return {"even": rng.normal(0, 1, (4000, 8)), "heavy": heavy, "ties": ties}


@pytest.mark.parametrize("name", ["even", "heavy", "ties"])
def test_bucket_knn_recall(spark, name):
    """At least 0.9 of the true neighbours, and the exact search finds all of them."""
    from cardpanel.operators import neighbors as nb
    x = _clouds()[name]
    df, names = _frame_of(spark, x)
    d = np.zeros((len(x), len(x)))
    for f in range(x.shape[1]):
        d += (x[:, f, None] - x[None, :, f]) ** 2
    np.fill_diagonal(d, np.inf)
    truth = np.sqrt(np.sort(d, axis=1)[:, :5])
    exact = nb.exact_knn(df, "id", names, 5, block_size=128)
    got = exact.toPandas().sort_values(["pid", "slot"])
    assert np.array_equal(got["distance"].to_numpy().reshape(len(x), 5), truth)
    found = nb.bucket_knn(df, "id", names, 5)
    assert found.groupBy("pid").count().filter("count = 5").count() == len(x)
    assert nb.recall(found, exact) >= 0.9


def test_nearest_of_a_group_equal_brute_force():
    """Equal distances go by id; large offsets, repeated ids and members that are not finite do no harm."""
    from cardpanel.operators import neighbors as nb
    rng = np.random.default_rng(4)
    for trial in range(60):
        n = int(rng.integers(2, 80))
        x = rng.integers(0, 3, (n, 3)) * 10.0 ** rng.integers(-3, 6) + (0.0, 1e8)[trial % 2]
        if trial % 3 == 0:
            x = x + rng.normal(size=x.shape)
        ids = rng.integers(0, 40, n).astype(float) if trial % 4 == 0 else rng.permutation(n).astype(float)
        mem = rng.permutation(n)[: max(1, n // 2)]
        if trial % 5 == 0:
            x[mem[0], 0] = np.nan
        want = []
        for i in range(n):
            d2 = np.zeros(len(mem))
            for f in range(3):
                d2 += (x[i, f] - x[mem, f]) ** 2
            near = sorted((d, j) for d, j in zip(d2, ids[mem]) if np.isfinite(d) and j != ids[i])[:5]
            want += [(ids[i], j, np.sqrt(d)) for d, j in near]
        assert list(zip(*(v.tolist() for v in nb._topk(x, x[mem], 5, ids, ids[mem])))) == want, trial


def test_radius_of_the_exact_search_asks_few_buckets(spark, monkeypatch):
    from cardpanel.operators import neighbors as nb
    x, asked, whole = _clouds()["even"], [], nb._in_parts
    df, names = _frame_of(spark, x)

    def counted(members, askers, keys, *rest):
        if keys == ["__tree", "__leaf"]:
            asked.append(askers.count())
        return whole(members, askers, keys, *rest)

    monkeypatch.setattr(nb, "_in_parts", counted)
    exact = nb.exact_knn(df, "id", names, 5, block_size=128)
    assert exact.count() == 5 * len(x) and asked == [9 * len(x)]


def test_box_tree_finds_what_all_boxes_do():
    from cardpanel.operators import neighbors as nb
    rng = np.random.default_rng(2)
    lo = rng.random((3000, 3))
    hi = lo + rng.random((3000, 3)) * 0.05
    x, r = rng.random((200, 3)), rng.random(200) * 0.1
    gap = np.maximum(np.maximum(lo - x[:, None], 0), x[:, None] - hi)
    want = np.sqrt((gap ** 2).sum(2)) <= r[:, None]
    row, box = nb._closer(nb._box_levels(lo, hi), x, r)
    assert sorted(zip(row, box)) == sorted(zip(*np.nonzero(want)))


def test_smote_by_buckets(spark):
    from cardpanel.operators.neighbors import smote
    rng = np.random.default_rng(5)
    x = rng.normal(0, 1, (900, 3))
    df = spark.createDataFrame([(i, *map(float, r), int(i % 3 == 0)) for i, r in enumerate(x)], "customer_id long, a double, b double, c double, y int")
    out = smote(df, NAMES, label="y", exact=False).toPandas()
    assert out.groupby("y").size().to_dict() == {0: 600, 1: 600}


def test_smote_balances_and_interpolates(spark):
    from cardpanel.operators.neighbors import smote
    rng = np.random.default_rng(4)
    rows = [(i, float(rng.random()), float(rng.random()), float(rng.random()), int(i % 4 == 0)) for i in range(200)]
    df = spark.createDataFrame(rows, "customer_id long, a double, b double, c double, y int")
    out = smote(df, NAMES, label="y", k=5).toPandas()
    counts = out.groupby("y").size().to_dict()
    assert counts[0] == counts[1] == 150
    orig = out[~out["synthetic"]]
    assert len(orig) == 200
    mino = np.array([r[1:4] for r in rows if r[4] == 1])
    syn = out[out["synthetic"]][NAMES].to_numpy()
    assert (syn >= mino.min(axis=0) - 1e-12).all() and (syn <= mino.max(axis=0) + 1e-12).all()


def test_gbt_resampling_inside_folds(spark):
    from cardpanel.plans.portfolio import PortfolioPlan
    p = PortfolioPlan(spark, "/root/testdata/sf0.001")
    d = md.training_frame(p.features, p.outcomes)
    t = md.train_gbt(d.filter(F.col("split") == "train"), grid={"maxDepth": [2], "stepSize": [0.1], "maxIter": [3]},
                     resample="smote_in_folds")
    assert len(t.cv_metrics) == 1 and 0.0 <= t.cv_metrics[0][1] <= 1.0
    scored = md.score_portfolio(t, d.select("customer_id", "default_next_month", *md.FEATURES))
    assert scored.count() == 150


def test_tree_attributions_log_odds(spark, small_gbt):
    df, d, model = small_gbt
    a = tree_attributions(df, model, NAMES, scale="log_odds").toPandas().set_index("customer_id").sort_index()
    prob = model.transform(d).select("customer_id", vector_to_array("probability")[1].alias("p")).toPandas()
    prob = prob.set_index("customer_id").sort_index()["p"].to_numpy()
    logit = np.log(prob / (1 - prob))
    assert np.allclose(a["base_value"] + a[NAMES].sum(axis=1), logit, atol=1e-8)


def test_split_and_folds_one_ranking_equals_separate(spark):
    p = PortfolioPlan(spark, "/root/testdata/sf0.001")
    lab = p.features.join(p.outcomes, "customer_id")
    both = {r["customer_id"]: (r["split"], r["fold"]) for r in md.split_and_folds(lab).collect()}
    s = {r["customer_id"]: r["split"] for r in md.stratified_split(lab).collect()}
    f = {r["customer_id"]: r["fold"] for r in md.with_folds(lab).collect()}
    assert both == {c: (s[c], f[c]) for c in s}


def test_weights_come_from_the_rows_before_resampling(spark):
    rows = [(i, float(i), int(i % 5 == 0)) for i in range(100)]
    original = spark.createDataFrame(rows, "customer_id long, a double, default_next_month int")
    resampled = original.union(original.filter("default_next_month = 1")).union(original.filter("default_next_month = 1"))
    weight = {r["default_next_month"]: r["weight"] for r in md.with_weights(resampled, mode="pos_ratio", counted=original).collect()}
    assert weight == {0: 1.0, 1: 4.0}
    assert {r["weight"] for r in md.with_weights(resampled, mode="pos_ratio").filter("default_next_month = 1").collect()} == {80 / 60}


def test_first_rounds_equal_a_shorter_run(spark, small_gbt):
    df, d, model = small_gbt
    short = GBTClassifier(labelCol="y", maxIter=2, maxDepth=3, seed=1).fit(d)
    assert md._first_rounds(model, 2).transform(d).select("probability").collect() == short.transform(d).select("probability").collect()


def test_search_scores_every_grid_point(spark):
    p = PortfolioPlan(spark, "/root/testdata/sf0.001")
    d = md.training_frame(p.features, p.outcomes)
    t = md.train_gbt(d.filter(F.col("split") == "train"), grid={"maxDepth": [2, 3], "stepSize": [0.1, 0.3], "maxIter": [2, 4]}, resample="smote")
    assert len(t.cv_metrics) == 8 and t.params == max(t.cv_metrics, key=lambda m: m[1])[0]
    assert t.model.getNumTrees == t.params["maxIter"]


def test_smote_refuses_what_it_cannot_do(spark):
    from cardpanel.operators.neighbors import smote
    few = spark.createDataFrame([(i, 0.1 * i, int(i < 3)) for i in range(30)], "customer_id long, a double, y int")
    with pytest.raises(ValueError):
        smote(few, ["a"], label="y", k=5)
    with pytest.raises(ValueError):
        smote(few.filter("y = 0"), ["a"], label="y")


@pytest.fixture
def search(spark):
    """(train, grid, store) of a search of two shapes over three folds."""
    import uuid

    from cardpanel.sources.models import ModelStore
    rng = np.random.default_rng(6)
    x = rng.normal(0, 1, (240, 3))
    rows = [(i, *map(float, r), int(r[0] + r[1] * r[2] > 0.5), i % 3) for i, r in enumerate(x)]
    train = spark.createDataFrame(rows, "customer_id long, a double, b double, c double, y int, fold int")
    return train, {"maxDepth": [2, 3], "stepSize": [0.1], "maxIter": [2, 4]}, ModelStore(spark, f"test-{uuid.uuid4().hex}")


def test_search_goes_on_where_it_stopped(spark, search, monkeypatch):
    train, grid, store = search
    fits, whole = [], GBTClassifier.fit

    def fit(self, data):
        fits.append(self.getMaxDepth())
        if len(fits) == 4:
            raise RuntimeError("killed")
        return whole(self, data)

    monkeypatch.setattr(md.GBTClassifier, "fit", fit)
    run = lambda: md.train_gbt(train, "y", NAMES, grid, store=store, parallelism=1)
    with pytest.raises(RuntimeError, match="killed"):
        run()
    assert store.load() is None
    first = run()
    assert len(fits) == 4 + 3 + 1  # three scores were kept, three were left, and the refit
    again = run()
    assert len(fits) == 8 and again.params == first.params and again.cv_metrics == first.cv_metrics and len(first.cv_metrics) == 4
    p, q = (sorted(map(tuple, md.score_portfolio(t, train, NAMES).collect())) for t in (first, again))
    assert p == q
    plain = md.train_gbt(train, "y", NAMES, grid)
    assert plain.cv_metrics == first.cv_metrics


def test_fingerprint_names_rows_and_settings(spark, search):
    from cardpanel.sources.models import fingerprint
    train, cols = search[0], ["customer_id", *NAMES, "y"]
    key = fingerprint(train, cols, {"grid": [1]})
    assert fingerprint(train.repartition(3).orderBy("a"), cols, {"grid": [1]}) == key
    assert fingerprint(train, cols, {"grid": [2]}) != key
    assert fingerprint(train.withColumn("a", F.when(F.col("customer_id") == 5, 9.0).otherwise(F.col("a"))), cols, {"grid": [1]}) != key
    assert fingerprint(train.unionByName(train.limit(1)), cols, {"grid": [1]}) != key


def test_stored_logistic_model_keeps_its_scaler(spark, search):
    train, _, store = search
    first = md.train_logistic(train, "y", NAMES, store=store)
    again = md.train_logistic(train.limit(5), "y", NAMES, store=store)  # loaded: the rows don't matter
    assert again.scaler == first.scaler and set(first.scaler) == set(NAMES)
    one = train.filter("customer_id = 7")
    assert md.score_portfolio(again, one, NAMES).first()["risk_score"] == md.score_portfolio(first, one, NAMES).first()["risk_score"]
    z = md.standardize(train, NAMES).filter("customer_id = 7").first()
    s = md.scaled(one, first.scaler).first()
    assert [s[c] for c in NAMES] == pytest.approx([z[c] for c in NAMES])
