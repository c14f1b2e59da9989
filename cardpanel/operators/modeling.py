"""Default models on Spark ML, with exact, distributed data preparation.

* ``stratified_split`` / ``with_folds`` / ``sample_n``: deterministic, seeded,
  exact.  Rows are ordered by an arithmetic hash of (key, seed) inside each
  label; a histogram of (label, leading hash bits) gives every bucket its place,
  and ranks are taken inside buckets (no window over a whole label class, which
  would be one task per class, and no range sort).
* ``standardize``: population mean / std (the scaler convention of the
  reference) as column arithmetic; the statistics are one aggregation.
* ``train_logistic`` / ``train_gbt``: Spark ML estimators with class weights;
  grid search over a fold column, several fits at a time, scored by average
  precision computed as a distributed aggregate.
* Training frames are cut from their lineage with a reliable checkpoint
  (shared checkpoint folder), so iterations re-read materialised data and a
  lost executor does not replay the feature pipeline.
"""

from __future__ import annotations

import itertools
import time
from dataclasses import dataclass, field

import numpy as np
from pyspark import SparkContext
from pyspark.ml import Model
from pyspark.ml.classification import GBTClassificationModel, LogisticRegression
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardpanel.operators.boosting import Fit, GBTClassifier, boosted
from cardpanel.operators.evaluation import average_precision, class_weights
from cardpanel.schema import FEATURES
from cardpanel.session import cut_lineage
from cardpanel.sources.models import ModelStore

# Hash constants (prime modulus 2^31 - 1, a linear congruential
# multiplier, the minimal-standard multiplier, seed multiplier, shift).
HASH_MOD, HASH_LCG, HASH_MUL, HASH_SEED_MUL, HASH_SHIFT = 2147483647, 1103515245, 48271, 16807, 15


def seeded_hash(key: str | Column = "customer_id", seed: int = 42) -> Column:
    """Deterministic pseudo-random order key in [0, 2^31 - 1), reproducible
    in any SQL engine: an LCG step on the key, an xor-shift, a second
    multiplicative step.  All products stay below 2^63 for any long key."""
    h = (((F.col(key) if isinstance(key, str) else key) % HASH_MOD) * HASH_LCG + F.lit(seed * HASH_SEED_MUL)) % HASH_MOD
    h = h.bitwiseXOR(F.shiftright(h, HASH_SHIFT))
    return (h * HASH_MUL) % HASH_MOD


#: Rows of a hash bucket, about; bits of the bucket number at most.
BUCKET_ROWS, BUCKET_BITS = 50_000, 20


def _bucketed(df: DataFrame, label: str, key: str, seed: int) -> tuple[DataFrame, DataFrame]:
    """Labelled rows with ``__h`` and ``__bucket`` (leading bits of the hash, so buckets
    follow its order), and the histogram: rows of each (class, bucket), of the buckets
    before it and of the class.  The histogram has classes x buckets rows."""
    df = df.filter(F.col(label).isNotNull())
    bits = min(BUCKET_BITS, max(0, (df.count() // BUCKET_ROWS).bit_length()))
    rows = df.withColumn("__h", seeded_hash(key, seed)).withColumn("__bucket", F.shiftright("__h", 31 - bits))
    sizes = rows.groupBy(label, "__bucket").agg(F.count(F.lit(1)).alias("__size"))
    w = Window.partitionBy(label)
    before = F.sum("__size").over(w.orderBy("__bucket")) - F.col("__size")
    return rows, sizes.select(label, "__bucket", "__size", before.alias("__before"), F.sum("__size").over(w).alias("__n"))


def _ranked(df: DataFrame, label: str, key: str, seed: int) -> DataFrame:
    """Rows with their class's size and their rank 0.. in it by (hash, key): ranked
    inside their bucket, plus the rows of the buckets before."""
    rows, sizes = _bucketed(df, label, key, seed)
    w = Window.partitionBy(label, "__bucket").orderBy("__h", key)
    inside = rows.withColumn("__inside", F.row_number().over(w) - 1)
    joined = inside.join(sizes.select(label, "__bucket", "__before", "__n"), [label, "__bucket"])
    return joined.withColumn("rank", F.col("__before") + F.col("__inside")).drop("__bucket", "__before", "__inside")


def stratified_split(df: DataFrame, label: str = "default_next_month", test: float = 0.2, seed: int = 42,
                     key: str = "customer_id") -> DataFrame:
    """Adds ``split`` = 'test' for the first round(test x n_class) rows of each
    class in (hash, key) order, 'train' otherwise: class shares kept exactly.  Only
    the bucket that holds a class's cut is ranked, for the last test row; the others
    are compared with that row, so no row is shuffled.  Rows without label are left out."""
    rows, sizes = _bucketed(df, label, key, seed)
    place = F.round(F.lit(test) * F.col("__n")) - F.col("__before")
    cuts = sizes.withColumn("__place", place).filter((F.col("__place") >= 1) & (F.col("__place") <= F.col("__size")))
    w = Window.partitionBy(label).orderBy("__h", key)  # one bucket a class
    held = rows.select(label, "__bucket", "__h", key).join(cuts.select(label, "__bucket", "__place"), [label, "__bucket"])
    last = held.withColumn("__nth", F.row_number().over(w)).filter(F.col("__nth") == F.col("__place"))
    last = last.select(label, F.struct(F.col("__h").alias("h"), F.col(key).alias("k")).alias("__last"))
    out = rows.join(last, label, "left")  # one row a class
    is_test = F.coalesce(F.struct(F.col("__h").alias("h"), F.col(key).alias("k")) <= F.col("__last"), F.lit(False))
    return out.withColumn("split", F.when(is_test, F.lit("test")).otherwise(F.lit("train"))).drop("__h", "__bucket", "__last")


def with_folds(df: DataFrame, label: str = "default_next_month", k: int = 3, seed: int = 42,
               key: str = "customer_id") -> DataFrame:
    """Stratified fold id 0..k-1: position in hash order within the class, mod k."""
    r = _ranked(df, label, key, seed)
    return r.withColumn("fold", (F.col("rank") % k).cast("int")).drop("__h", "__n", "rank")


def split_and_folds(df: DataFrame, label: str = "default_next_month", test: float = 0.2, k: int = 3,
                    seed: int = 42, key: str = "customer_id") -> DataFrame:
    """``split`` and ``fold`` from ONE ranking (same values as
    ``stratified_split`` and ``with_folds`` with the same seed)."""
    r = _ranked(df, label, key, seed)
    cut = F.round(F.lit(test) * F.col("__n"))
    return (r.withColumn("split", F.when(F.col("rank") < cut, F.lit("test")).otherwise(F.lit("train")))
            .withColumn("fold", (F.col("rank") % k).cast("int")).drop("__h", "__n", "rank"))


def sample_n(df: DataFrame, n: int = 2000, seed: int = 42, key: str = "customer_id") -> DataFrame:
    """Seeded sample of min(n, rows) rows: the n smallest hash values (a
    top-n, not a global sort)."""
    return (df.withColumn("__h", seeded_hash(key, seed)).orderBy("__h", key).limit(n).drop("__h"))


def standardize(df: DataFrame, names=FEATURES, population: bool = True, ref: DataFrame | None = None) -> DataFrame:
    """(x - mean) / std per feature, with the statistics of ``ref`` (default:
    ``df`` itself, e.g. the training rows); a constant column maps to 0."""
    std = F.stddev_pop if population else F.stddev_samp
    stats = (ref if ref is not None else df).agg(*[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in names],
                   *[std(F.col(c).cast("double")).alias(f"s_{c}") for c in names])
    out = df
    for c in names:
        m, s = stats.select(f"m_{c}").scalar(), stats.select(f"s_{c}").scalar()
        out = out.withColumn(c, F.when(s > 0, (F.col(c).cast("double") - m) / s).otherwise(F.lit(0.0)))
    return out


def scaler_of(df: DataFrame, names=FEATURES) -> dict[str, list[float]]:
    """Mean and population deviation of each feature: two numbers each."""
    stats = [f(F.col(c).cast("double")).alias(f"{k}_{c}") for c in names for k, f in (("m", F.avg), ("s", F.stddev_pop))]
    row = df.agg(*stats).first()
    return {c: [row[f"m_{c}"] or 0.0, row[f"s_{c}"] or 0.0] for c in names}


def scaled(df: DataFrame, scaler: dict[str, list[float]]) -> DataFrame:
    """``standardize`` with statistics taken before."""
    return df.withColumns({c: (F.col(c).cast("double") - m) / s if s > 0 else F.lit(0.0) for c, (m, s) in scaler.items()})


def assemble(df: DataFrame, names=FEATURES, out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(names), outputCol=out).transform(df)


def with_weights(df: DataFrame, label: str = "default_next_month", mode: str = "balanced",
                 counted: DataFrame | None = None) -> DataFrame:
    """weight column: balanced n / (2 n_class), or 'pos_ratio' (positives get
    n0 / n1, negatives 1), or 'none'.  The classes are counted in ``counted``
    (default: ``df`` itself), e.g. the rows before resampling."""
    if mode == "none":
        return df.withColumn("weight", F.lit(1.0))
    w = class_weights(counted if counted is not None else df, label)
    if mode == "balanced":
        w = w.select(label, "weight")
    elif mode == "pos_ratio":
        w = w.select(label, F.when(F.col(label) == 1, F.col("imbalance_ratio")).otherwise(F.lit(1.0)).alias("weight"))
    else:
        raise ValueError(mode)
    return df.join(F.broadcast(w), label)  # one row per class: bounded


def positive_probability(pred: DataFrame, out: str = "risk_score") -> DataFrame:
    return pred.withColumn(out, vector_to_array("probability")[1])


class AveragePrecisionEvaluator(Evaluator):
    """Step-wise average precision of P(label = 1), computed as a distributed
    aggregate (``evaluation.average_precision``)."""

    def __init__(self, label: str = "default_next_month"):
        super().__init__()
        self.label = label

    def _evaluate(self, dataset: DataFrame) -> float:
        s = positive_probability(dataset).select("risk_score", F.col(self.label).cast("int").alias(self.label))
        v = average_precision(s, "risk_score", self.label).first()[0]
        return float(v) if v is not None else 0.0

    def isLargerBetter(self) -> bool:
        return True


@dataclass
class Trained:
    model: Model
    kind: str
    params: dict = field(default_factory=dict)
    cv_metrics: list = field(default_factory=list)
    scaler: dict[str, list[float]] = field(default_factory=dict)  # mean and deviation of each input, where it was scaled

    @classmethod
    def stored(cls, store: ModelStore | None) -> Trained | None:
        """The model of a finished store."""
        if store is None or (found := store.load()) is None:
            return None
        model, record = found
        return cls(model, record["kind"], record["params"], [tuple(m) for m in record["cv_metrics"]], record["scaler"])

    def save(self, store: ModelStore | None) -> Trained:
        if store is not None:
            store.save(self.model, self.kind, params=self.params, cv_metrics=self.cv_metrics, scaler=self.scaler)
        return self


def training_frame(features: DataFrame, outcomes: DataFrame, label: str = "default_next_month",
                   names=FEATURES, test: float = 0.2, seed: int = 42, folds: int = 3) -> DataFrame:
    """features + label + split + fold, checkpointed once for all fits."""
    d = split_and_folds(features.join(outcomes, "customer_id"), label, test, folds, seed)
    return cut_lineage(d)


def train_logistic(train: DataFrame, label: str = "default_next_month", names=FEATURES,
                   max_iter: int = 1000, c: float = 1.0, store: ModelStore | None = None) -> Trained:
    """Balanced-weight logistic regression on population-standardised
    features; regParam = 1 / (C x sum of weights) matches an L2 penalty
    0.5 ||b||^2 + C x weighted log-loss.  The scaler goes with the model."""
    if done := Trained.stored(store):
        return done
    scaler = scaler_of(train, names)
    d = with_weights(scaled(train, scaler), label, "balanced")
    d = assemble(d, names)
    total_w = d.agg(F.sum("weight")).first()[0]
    lr = LogisticRegression(featuresCol="features", labelCol=label, weightCol="weight", maxIter=max_iter,
                            regParam=1.0 / (c * total_w), elasticNetParam=0.0, standardization=False, tol=1e-8)
    return Trained(lr.fit(d), "logistic", {"regParam": 1.0 / (c * total_w)}, scaler=scaler).save(store)


def newton_logistic(train: DataFrame, label: str = "default_next_month", names=FEATURES, c: float = 1.0,
                    steps: int = 50, tol: float = 1e-10) -> dict[str, float]:
    """The optimum that ``train_logistic`` aims at, by Newton's method: every step is one
    aggregation (gradient and Hessian, (d + 1)(d + 4) / 2 sums) and a solve of d + 1
    equations.  Coefficients on the scaled features, with "intercept"."""
    names = list(names)
    d = cut_lineage(with_weights(scaled(train, scaler_of(train, names)), label, "balanced").select(label, "weight", *names))
    x = [F.lit(1.0), *[F.col(n) for n in names]]
    k, b = len(x), np.zeros(len(names) + 1)
    ridge = np.diag([0.0, *[1.0 / c] * len(names)])  # the intercept is free
    pairs = [(i, j) for i in range(k) for j in range(i + 1)]
    for _ in range(steps):
        p = 1 / (1 + F.exp(-sum((x[i] * F.lit(float(b[i])) for i in range(k)), F.lit(0.0))))
        rows = d.withColumn("__p", p)
        curve, miss = F.col("weight") * F.col("__p") * (1 - F.col("__p")), F.col("weight") * (F.col(label) - F.col("__p"))
        sums = rows.agg(*[F.sum(curve * x[i] * x[j]) for i, j in pairs], *[F.sum(miss * x[i]) for i in range(k)]).first()
        hessian = np.zeros((k, k))
        for (i, j), v in zip(pairs, sums):
            hessian[i, j] = hessian[j, i] = v
        move = np.linalg.solve(hessian + ridge, np.array(sums[len(pairs):]) - ridge @ b)
        b += move
        if np.abs(move).max() < tol:
            break
    return dict(zip(["intercept", *names], b.tolist()))


# The boosted-tree search grid.
DEFAULT_GRID = {"maxDepth": [3, 5, 7], "stepSize": [0.01, 0.1], "maxIter": [100, 300]}


def train_gbt(train: DataFrame, label: str = "default_next_month", names=FEATURES, grid: dict | None = None,
              folds: int = 3, seed: int = 42, weight_mode: str = "pos_ratio", parallelism: int | None = None,
              resample: str | None = None, store: ModelStore | None = None) -> Trained:
    """Boosted trees, grid-searched by k-fold CV on the ``fold`` column with
    average precision; the best grid point is refit on all training rows.

    ``resample="smote"`` oversamples the minority class first and assigns the
    folds on the resampled rows - the reference order (synthetic rows can
    then inform the validation folds), kept for faithfulness; the class ratio
    of the weights is that of the original training rows, as there.
    ``resample="smote_in_folds"`` resamples only each fold's training part
    and validates on the untouched original rows of the held-out fold; its
    weights follow the resampled classes.

    ``parallelism`` fits grow together (default: all).  With a ``store`` their scores
    are written when they are through, and the model at the end: a search that was
    stopped goes on behind its last finished group, and a finished one trains nothing."""
    grid = grid or DEFAULT_GRID
    if done := Trained.stored(store):
        return done
    if resample == "smote_in_folds":
        return _train_gbt_resampled_folds(train, label, names, grid, folds, seed, weight_mode, parallelism, store)
    if resample == "smote":
        from cardpanel.operators.neighbors import smote
        res = smote(train.select("customer_id", *names, label), list(names), label, k=5, seed=seed)
        resampled = cut_lineage(with_folds(res, label, folds, seed))
        d = with_weights(resampled, label, weight_mode, counted=train)
    else:
        d = with_weights(train, label, weight_mode)
    d = _sized(assemble(d, names).withColumn(label, F.col(label).cast("double")))
    pairs = [(d.filter(F.col("fold") != k), d.filter(F.col("fold") == k)) for k in range(folds)]
    return _searched(pairs, d, label, grid, seed, parallelism, store)


#: Rows of a training partition: small tables are one task, so the many short jobs of boosting stay short.
ROWS_PER_TASK = 100_000


def _sized(d: DataFrame) -> DataFrame:
    d = cut_lineage(d)
    return d.coalesce(max(1, -(-d.count() // ROWS_PER_TASK)))


def _first_rounds(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The model after its first ``rounds`` trees: what a shorter run with the same
    depth, rate and seed would have trained."""
    sc, j = SparkContext._active_spark_context, model._java_obj
    ml = sc._jvm.org.apache.spark.ml
    trees = sc._gateway.new_array(ml.regression.DecisionTreeRegressionModel, rounds)
    weights = sc._gateway.new_array(sc._jvm.double, rounds)
    for i, (tree, weight) in enumerate(zip(j.trees()[:rounds], j.treeWeights()[:rounds], strict=True)):
        trees[i], weights[i] = tree, weight
    return GBTClassificationModel(ml.classification.GBTClassificationModel(f"{model.uid}_{rounds}", trees, weights))


def _searched(pairs: list[tuple[DataFrame, DataFrame]], rows: DataFrame, label: str, grid: dict, seed: int, parallelism: int | None,
              store: ModelStore | None) -> Trained:
    """Average precision of every grid point over (fit rows, held-out rows) pairs,
    and the best point refit on ``rows``.  Each depth and rate is trained once per
    pair, to the largest number of rounds; fewer rounds are its first trees."""
    rounds = sorted(grid["maxIter"])
    shapes = [dict(zip(("maxDepth", "stepSize"), x)) for x in itertools.product(grid["maxDepth"], grid["stepSize"])]
    evaluator = AveragePrecisionEvaluator(label)

    def trained(shape: dict, n: int, fit_rows: DataFrame) -> GBTClassificationModel:
        return GBTClassifier(featuresCol="features", labelCol=label, weightCol="weight", seed=seed, maxIter=n, **shape).fit(fit_rows)

    def name(job: tuple[int, int]) -> str:
        shape = shapes[job[0]]
        return f"scores/depth-{shape['maxDepth']}-rate-{shape['stepSize']}-fold-{job[1]}.json"

    def scores(some: list[tuple[int, int]]) -> list[dict[str, float]]:
        if len(some) == 1:
            shape, (fit_rows, held_out) = shapes[some[0][0]], pairs[some[0][1]]
            model = trained(shape, rounds[-1], fit_rows)
            return [{str(n): evaluator.evaluate(_first_rounds(model, n).transform(held_out)) for n in rounds}]
        fits = [Fit(k, shapes[a]["maxDepth"], shapes[a]["stepSize"]) for a, k in some]
        by_round = boosted(pairs, fits, rounds[-1], label, scored=rounds, seed=seed).scores
        return [{str(n): by_round[n][i] for n in rounds} for i in range(len(some))]

    jobs = [(a, k) for a in range(len(shapes)) for k in range(len(pairs))]
    found = {job: x for job in jobs if store is not None and (x := store.read(name(job))) is not None}
    left = [job for job in jobs if job not in found]
    for some in (left[i:i + (parallelism or len(left))] for i in range(0, len(left), parallelism or len(left) or 1)):
        began = time.monotonic()
        for job, x in zip(some, scores(some), strict=True):
            found[job] = x
            if store is not None:
                store.write(name(job), x | {"seconds": round(time.monotonic() - began, 1)})
    metrics = [({**shape, "maxIter": n}, sum(found[a, k][str(n)] for k in range(len(pairs))) / len(pairs))
               for a, shape in enumerate(shapes) for n in rounds]
    best = max(metrics, key=lambda m: m[1])[0]
    model = trained({k: best[k] for k in ("maxDepth", "stepSize")}, best["maxIter"], rows)
    return Trained(model, "gbt", best, metrics).save(store)


def score_portfolio(trained: Trained, df: DataFrame, names=FEATURES) -> DataFrame:
    """P(default) for every account, by a model just trained or a stored one (its
    own scaler, where it has one); the score is published under two names."""
    d = assemble(scaled(df, trained.scaler), names)
    p = positive_probability(trained.model.transform(d))
    return p.select("customer_id", "risk_score", F.col("risk_score").alias("fraud_risk_score"),
                    *[c for c in df.columns if c not in ("customer_id", *names)])


def logistic_coefficients(trained: Trained, names=FEATURES) -> dict[str, float]:
    coefs = trained.model.coefficients.toArray().tolist()
    return dict(zip(names, coefs))


def _train_gbt_resampled_folds(train: DataFrame, label: str, names, grid: dict, folds: int, seed: int,
                               weight_mode: str, parallelism: int | None, store: ModelStore | None) -> Trained:
    from cardpanel.operators.neighbors import smote

    def prepared(rows: DataFrame) -> DataFrame:
        res = smote(rows.select("customer_id", *names, label), list(names), label, k=5, seed=seed)
        d = assemble(with_weights(res, label, weight_mode), names)
        return _sized(d.withColumn(label, F.col(label).cast("double")))

    pairs = [(prepared(train.filter(F.col("fold") != k)), assemble(train.filter(F.col("fold") == k), names)) for k in range(folds)]
    return _searched(pairs, prepared(train), label, grid, seed, parallelism, store)
