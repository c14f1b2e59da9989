"""Registered queries: seeded splits (oracle-checked) and Spark ML models
(row-count checked; their exact scores depend on the learner)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardpanel.operators import evaluation as ev
from cardpanel.operators import explain as ex
from cardpanel.operators import modeling as md
from cardpanel.operators.treeshap import tree_attributions
from cardpanel.session import cut_lineage
from cardpanel.sources.models import ModelStore, fingerprint
from cardpanel.operators.features import clean_features
from cardpanel.plans.catalog import _plan, register
from cardpanel.plans.portfolio import _ON_REFRESH

_H1 = "(((customer_id % 2147483647) * 1103515245 + 42 * 16807) % 2147483647)"
HASH = f"((xor({_H1}, {_H1} >> 15) * 48271) % 2147483647)"
RANK_SQL = f"""
ranked AS (
  SELECT customer_id, default_next_month,
         ROW_NUMBER() OVER (PARTITION BY default_next_month ORDER BY {HASH}, customer_id) - 1 AS rk,
         COUNT(*) OVER (PARTITION BY default_next_month) AS n
  FROM credit_features JOIN outcomes USING (customer_id)
)
"""
def _labelled(p):
    return p.features.join(p.outcomes, "customer_id")


@register("stratified_split", """
SELECT customer_id, default_next_month, CASE WHEN rk < ROUND(0.2 * n) THEN 'test' ELSE 'train' END AS split
FROM ranked""", RANK_SQL, group="model")
def q_stratified_split(spark, sf_dir):
    d = md.stratified_split(_labelled(_plan(spark, sf_dir)))
    return d.select("customer_id", "default_next_month", "split")


@register("with_folds", "SELECT customer_id, default_next_month, CAST(rk % 3 AS INTEGER) AS fold FROM ranked",
          RANK_SQL, group="model")
def q_with_folds(spark, sf_dir):
    d = md.with_folds(_labelled(_plan(spark, sf_dir)), k=3)
    return d.select("customer_id", "default_next_month", "fold")


@register("sample_n", f"""
SELECT customer_id, avg_utilization, max_delinquency, on_time_months FROM credit_features
ORDER BY {HASH}, customer_id LIMIT 2000""", group="model")
def q_sample_n(spark, sf_dir):
    f = _plan(spark, sf_dir).features
    return md.sample_n(f, 2000).select("customer_id", "avg_utilization", "max_delinquency", "on_time_months")


@register("top_test_accounts", f"""
SELECT s.customer_id, s.risk_score FROM scores s JOIN ranked r USING (customer_id)
WHERE r.rk < ROUND(0.2 * r.n)
ORDER BY s.risk_score DESC, s.customer_id LIMIT 20""", RANK_SQL, group="model")
def q_top_test_accounts(spark, sf_dir):
    p = _plan(spark, sf_dir)
    test = md.stratified_split(_labelled(p)).filter(F.col("split") == "test").select("customer_id")
    return (p.scores.join(test, "customer_id").select("customer_id", "risk_score")
            .orderBy(F.col("risk_score").desc(), F.col("customer_id")).limit(20))


TEST_COST_SQL = RANK_SQL + """, thresholds AS (SELECT CAST(i AS DOUBLE) / 100.0 AS threshold FROM range(10, 91) g(i)),
test_scores AS (
  SELECT s.risk_score, s.default_next_month AS y FROM scores s JOIN ranked r USING (customer_id) WHERE r.rk < ROUND(0.2 * r.n)
),
cost AS (
  SELECT threshold, SUM(CASE WHEN y = 1 AND risk_score < threshold THEN 150 WHEN y = 0 AND risk_score >= threshold THEN 10 ELSE 0 END) AS total
  FROM thresholds, test_scores GROUP BY threshold
)
"""


@register("threshold_summary", """
SELECT opt.threshold AS optimal_threshold, CAST(ref.total AS BIGINT) AS cost_ref, CAST(opt.total AS BIGINT) AS cost_opt,
       CAST(ref.total - opt.total AS BIGINT) AS test_period_cost_saving, CAST((ref.total - opt.total) / 0.2 * 12 AS BIGINT) AS annualized_cost_saving
FROM (SELECT threshold, total FROM cost ORDER BY total, threshold LIMIT 1) opt, (SELECT total FROM cost WHERE threshold = 0.5) ref""",
          TEST_COST_SQL, group="model")
def q_threshold_summary(spark, sf_dir):
    """Costs of the test split alone; the annualised saving scales them to the portfolio and a year."""
    return ev.threshold_summary(ev.cost_curve(_plan(spark, sf_dir).test_scores))


_FRAMES: dict = {}
_MODELS: dict = {}


def _forget(key) -> None:
    for store in (_FRAMES, _MODELS):
        for k in [k for k in store if k[:2] == key]:
            store.pop(k)


_ON_REFRESH.append(_forget)


def frame_of(plan):
    """Cleaned features + label + split + folds, checkpointed once per application."""
    key = (plan.spark.sparkContext.applicationId, plan.sf_dir.rstrip("/"))
    if key not in _FRAMES:
        _FRAMES[key] = md.training_frame(clean_features(plan.features), plan.outcomes)
    return _FRAMES[key]


def store_of(plan, name, **settings):
    """The store of a model of this portfolio: named by its training rows and settings."""
    d = frame_of(plan)
    train = d.filter(F.col("split") == "train")
    columns = ["customer_id", *md.FEATURES, "default_next_month", "fold"]
    return ModelStore(plan.spark, fingerprint(train, columns, {"model": name, "version": 1, **settings}))


def model_of(plan, resample="smote"):
    """(frame, grid-searched boosted model): loaded from the store, or searched and stored."""
    d = frame_of(plan)
    key = (plan.spark.sparkContext.applicationId, plan.sf_dir.rstrip("/"), resample)
    if key not in _MODELS:
        store = store_of(plan, "gbt", grid=md.DEFAULT_GRID, resample=resample)
        _MODELS[key] = md.train_gbt(d.filter(F.col("split") == "train"), resample=resample, store=store)
    return d, _MODELS[key]


def logistic_of(plan):
    """(frame, logistic model), loaded or trained and stored."""
    d = frame_of(plan)
    return d, md.train_logistic(d.filter(F.col("split") == "train"), store=store_of(plan, "logistic"))


def _frame(spark, sf_dir):
    p = _plan(spark, sf_dir)
    return p, frame_of(p)


def _gbt(spark, sf_dir, resample="smote"):
    p = _plan(spark, sf_dir)
    return (p, *model_of(p, resample))


def _test_metrics(scored, name):
    s = scored.select("risk_score", "default_next_month")
    ap = ev.average_precision(s).first()[0]
    conf = ev.confusion(s, 0.5).first()
    return name, float(ap or 0.0), conf


@register("train_logistic", group="model")
def q_train_logistic(spark, sf_dir):
    """Balanced logistic baseline: test-set AP and confusion at 0.5, one row."""
    d, t = logistic_of(_plan(spark, sf_dir))
    scored = md.score_portfolio(t, d.filter(F.col("split") == "test"))
    name, ap, c = _test_metrics(scored, "logistic")
    return spark.createDataFrame([(name, ap, c.tn, c.fp, c.fn, c.tp)],
                                 "model string, average_precision double, tn long, fp long, fn long, tp long")


@register("logistic_attributions", group="model")
def q_logistic_attributions(spark, sf_dir):
    """Exact linear attributions of the logistic model (standardised inputs)."""
    d, t = logistic_of(_plan(spark, sf_dir))
    z = md.scaled(d.filter(F.col("split") == "train"), t.scaler)
    return ex.attribution_importance(ex.linear_attributions(z, md.logistic_coefficients(t)))


@register("train_gbt", group="model")
def q_train_gbt(spark, sf_dir):
    """Grid search (3 stratified folds, AP) of boosted trees without resampling:
    one row per grid point."""
    p, d, t = _gbt(spark, sf_dir, resample=None)
    rows = [(int(g["maxDepth"]), float(g["stepSize"]), int(g["maxIter"]), m) for g, m in t.cv_metrics]
    return spark.createDataFrame(rows, "max_depth int, step_size double, max_iter int, cv_average_precision double")


@register("score_portfolio", group="model")
def q_score_portfolio(spark, sf_dir):
    """Best boosted model scores every account (train and test rows)."""
    p, d, t = _gbt(spark, sf_dir)
    return md.score_portfolio(t, d.select("customer_id", "default_next_month", *md.FEATURES)) \
        .select("customer_id", "risk_score", "fraud_risk_score", "default_next_month")


@register("model_metrics", group="model")
def q_model_metrics(spark, sf_dir):
    """The metrics record of a run, one row; see ``model_metrics``."""
    return model_metrics(_plan(spark, sf_dir))


def _confusion(scored, threshold, name):
    c = ev.confusion(scored, threshold)
    return c.select(F.array("tn", "fp", "fn", "tp").alias(name)).scalar()


def model_metrics(plan):
    """Accounts and default rate; on the test split: average precision of the
    boosted and the logistic model, optimum threshold by cost, F2 there, costs and
    savings, confusion (tn, fp, fn, tp) at 0.50 and at the optimum of either; the
    best grid point; the three features of highest mean |attribution|."""
    d, t = model_of(plan)
    test = d.filter(F.col("split") == "test")
    s = cut_lineage(md.score_portfolio(t, test.select("customer_id", "default_next_month", *md.FEATURES)).select("risk_score", "default_next_month"))
    base = md.score_portfolio(logistic_of(plan)[1], test).select("risk_score", "default_next_month")
    curve = ev.cost_curve(s)
    best_t = float(ev.optimal_threshold(curve).select("threshold").first()[0])
    f2 = ev.fbeta(ev.confusion(s, best_t), 2.0).select(F.col("fbeta").alias("f2_at_optimum"))
    top = ex.attribution_importance(tree_attributions(test, t.model)).filter(F.col("rank") <= 3).agg(
        F.array_join(F.sort_array(F.collect_list(F.struct("rank", "feature_name"))).getField("feature_name"), ",").alias("top_features"))
    labels = d.agg(F.count(F.lit(1)).alias("accounts"), (100 * F.avg("default_next_month")).alias("overall_default_rate"))
    return (ev.threshold_summary(curve).withColumns({
        "accounts": labels.select("accounts").scalar(), "overall_default_rate": labels.select("overall_default_rate").scalar(),
        "f2_at_optimum": f2.scalar(), "average_precision": ev.average_precision(s).scalar(),
        "logistic_average_precision": ev.average_precision(base).scalar(), "logistic_confusion_at_050": _confusion(base, 0.5, "c"),
        "confusion_at_050": _confusion(s, 0.5, "c"), "confusion_at_optimum": _confusion(s, best_t, "c"),
        "best_max_depth": F.lit(int(t.params["maxDepth"])), "best_step_size": F.lit(float(t.params["stepSize"])),
        "best_max_iter": F.lit(int(t.params["maxIter"])), "top_features": top.scalar()}))


@register("tree_attributions", group="model")
def q_tree_attributions(spark, sf_dir):
    """Mean |Shapley value| per feature (margin scale) over the whole test split, ranked."""
    _, d, t = _gbt(spark, sf_dir)
    return ex.attribution_importance(tree_attributions(d.filter(F.col("split") == "test"), t.model))


@register("tree_top_drivers", group="model")
def q_tree_top_drivers(spark, sf_dir):
    """Top 20 test accounts by model score with their three largest drivers."""
    return tree_top_drivers(_plan(spark, sf_dir))


def tree_top_drivers(plan, n=20):
    d, t = model_of(plan)
    test = d.filter(F.col("split") == "test")
    scored = md.score_portfolio(t, test.select("customer_id", "default_next_month", *md.FEATURES))
    top = scored.orderBy(F.col("risk_score").desc(), F.col("customer_id")).limit(n)
    attr = tree_attributions(top.join(test.select("customer_id", *md.FEATURES), "customer_id"), t.model)
    return ex.top_drivers(top, attr, n)


def _hash_sql(x: str, seed: str) -> str:
    h = f"((({x}) % {md.HASH_MOD} * {md.HASH_LCG} + ({seed}) * {md.HASH_SEED_MUL}) % {md.HASH_MOD})"
    return f"((xor({h}, {h} >> {md.HASH_SHIFT}) * {md.HASH_MUL}) % {md.HASH_MOD})"


_X = [f"CAST({c} AS DOUBLE) AS {c}" for c in md.FEATURES]
_D2 = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in md.FEATURES)
_DRAWS = ", ".join(f"{_hash_sql(_hash_sql('j', str(42 + s)), '42')} AS h{s}" for s in (1, 2, 3))
SMOTE_SQL = RANK_SQL + f""", train AS (
  SELECT customer_id, {", ".join(_X)}, default_next_month FROM credit_features JOIN ranked USING (customer_id) WHERE rk >= ROUND(0.2 * n)
),
classes AS (SELECT default_next_month AS y, COUNT(*) AS n FROM train GROUP BY 1),
minority AS (SELECT * FROM train WHERE default_next_month = (SELECT y FROM classes ORDER BY n, y LIMIT 1)),
near AS (
  SELECT a.customer_id AS pid, b.customer_id AS nid, ROW_NUMBER() OVER (PARTITION BY a.customer_id ORDER BY SQRT({_D2}), b.customer_id) - 1 AS slot
  FROM minority a JOIN minority b ON a.customer_id <> b.customer_id
),
numbered AS (SELECT *, ROW_NUMBER() OVER (ORDER BY {_hash_sql("customer_id", "42")}, customer_id) - 1 AS i FROM minority),
draws AS (
  SELECT j, {_DRAWS} FROM (SELECT UNNEST(RANGE((SELECT MAX(n) - MIN(n) FROM classes))) AS j)
)
"""


@register("smote", f"""
SELECT customer_id, {", ".join(md.FEATURES)}, default_next_month, FALSE AS synthetic FROM train
UNION ALL
SELECT -(j + 1), {", ".join(f"a.{c} + h3 / {md.HASH_MOD}.0::DOUBLE * (b.{c} - a.{c})" for c in md.FEATURES)}, a.default_next_month, TRUE
FROM draws JOIN numbered a ON a.i = h1 % (SELECT MIN(n) FROM classes)
JOIN near ON near.pid = a.customer_id AND near.slot = h2 % 5 JOIN minority b ON b.customer_id = near.nid""", SMOTE_SQL, group="model")
def q_smote(spark, sf_dir):
    """Training split oversampled to class parity (exact 5-nearest minority
    neighbours, seeded interpolation); originals kept, synthetic rows flagged."""
    from cardpanel.operators.neighbors import smote
    p, d = _frame(spark, sf_dir)
    train = d.filter(F.col("split") == "train").select("customer_id", *[F.col(c).cast("double").alias(c) for c in md.FEATURES], "default_next_month")
    return smote(train, list(md.FEATURES))


@register("train_gbt_smote", group="model")
def q_train_gbt_smote(spark, sf_dir):
    """Grid search on the SMOTE-resampled training split (reference order)."""
    p, d, t = _gbt(spark, sf_dir)
    rows = [(int(g["maxDepth"]), float(g["stepSize"]), int(g["maxIter"]), m) for g, m in t.cv_metrics]
    return spark.createDataFrame(rows, "max_depth int, step_size double, max_iter int, cv_average_precision double")


@register("train_gbt_smote_in_folds", group="model")
def q_train_gbt_smote_in_folds(spark, sf_dir):
    """Grid search with SMOTE applied to each fold's training part only
    (validation on untouched original rows): the leak-free variant."""
    p, d, t = _gbt(spark, sf_dir, resample="smote_in_folds")
    rows = [(int(g["maxDepth"]), float(g["stepSize"]), int(g["maxIter"]), m) for g, m in t.cv_metrics]
    return spark.createDataFrame(rows, "max_depth int, step_size double, max_iter int, cv_average_precision double")
