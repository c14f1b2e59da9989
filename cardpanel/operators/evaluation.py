"""Evaluation of a score against the default label, as distributed aggregates.

* ``cost_curve``: each score is mapped to the number of grid thresholds it
  reaches (two comparisons against exact grid literals), counted per
  (index, label) - at most (grid+1) x 2 rows leave the map side - and fn / fp
  at every threshold are running sums over that tiny table.  One pass over
  the scores whatever the grid size; no scores x thresholds expansion.
* ``average_precision`` / ``pr_curve``: step-wise precision-recall over the
  distinct scores in descending order, via ``ordered.running_sums`` (no
  single-partition window over the scores).
* confusion matrix, classification report and F-beta: one aggregation of
  four conditional counts, then arithmetic on one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardpanel.functions.columns import interval_label, right_closed_bin
from cardpanel.operators.ordered import running_sums

# Business costs of a missed defaulter and of a false alert;
# threshold grid 0.10 .. 0.90 in steps of 0.01 (as integers over 100).
COST_FN, COST_FP = 150, 10
GRID_LO, GRID_HI, GRID_SCALE = 10, 90, 100


def score_bins(edges_count: int = 10) -> list[float]:
    """Equal-width edges on [0, 1] computed as i * (1 / k) with the last edge
    exactly 1.0 (the float values an evenly spaced grid produces)."""
    step = 1.0 / edges_count
    return [i * step for i in range(edges_count)] + [1.0]


def grid_index(score, lo: int = GRID_LO, hi: int = GRID_HI, scale: int = GRID_SCALE):
    """Number of thresholds i/scale (i = lo..hi) that are <= score, exactly."""
    s = F.col(score) if isinstance(score, str) else score
    i0 = F.floor(s * F.lit(float(scale)))
    base = F.least(F.greatest(i0 - F.lit(lo) + 1, F.lit(0)), F.lit(hi - lo + 1))
    up = (i0 + 1 >= lo) & (i0 + 1 <= hi) & ((i0 + 1).cast("double") / F.lit(float(scale)) <= s)
    down = (i0 >= lo) & (i0 <= hi) & (i0.cast("double") / F.lit(float(scale)) > s)
    return (base + F.when(up, 1).otherwise(0) - F.when(down, 1).otherwise(0)).cast("int")


def cost_curve(scored: DataFrame, score: str = "risk_score", label: str = "default_next_month",
               lo: int = GRID_LO, hi: int = GRID_HI, scale: int = GRID_SCALE,
               c_fn: int = COST_FN, c_fp: int = COST_FP) -> DataFrame:
    """threshold, fn, fp, total_cost for thresholds lo/scale .. hi/scale."""
    spark = scored.sparkSession
    y = F.col(label)
    counts = (scored.select(grid_index(score, lo, hi, scale).alias("k"), y.alias("y"))
              .groupBy("k").agg(F.count_if(F.col("y") == 0).alias("n0"), F.count_if(F.col("y") == 1).alias("n1")))
    g = hi - lo + 1
    grid = spark.range(0, g + 1).select(F.col("id").cast("int").alias("k"))
    full = grid.join(counts, "k", "left").na.fill(0, ["n0", "n1"])
    w = Window.partitionBy().orderBy("k")  # bounded: g + 1 rows
    c = full.select("k",
                    F.coalesce(F.sum("n1").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("fn"),
                    F.sum("n0").over(w.rowsBetween(0, Window.unboundedFollowing)).alias("fp"))
    c = c.filter(F.col("k") >= 1)
    return c.select(((F.col("k") + lo - 1).cast("double") / F.lit(float(scale))).alias("threshold"),
                    F.col("fn").cast("long").alias("fn"), F.col("fp").cast("long").alias("fp"),
                    (F.col("fn") * c_fn + F.col("fp") * c_fp).cast("long").alias("total_cost"))


def optimal_threshold(curve: DataFrame) -> DataFrame:
    """Lowest cost; ties go to the lowest threshold."""
    return curve.orderBy(F.col("total_cost").asc(), F.col("threshold").asc()).limit(1)


def cost_at(curve: DataFrame, t: float = 0.5) -> DataFrame:
    """Curve row whose threshold is nearest to t (ties: lower threshold)."""
    return curve.orderBy(F.abs(F.col("threshold") - F.lit(t)).asc(), F.col("threshold").asc()).limit(1)


def threshold_summary(curve: DataFrame, reference: float = 0.5, test_share: float = 0.2, months: int = 12) -> DataFrame:
    """Optimum, cost at the reference threshold, saving, annualised saving
    (test saving scaled to the whole portfolio, then to a year)."""
    best = optimal_threshold(curve).select(F.col("threshold").alias("optimal_threshold"),
                                           F.col("total_cost").alias("cost_opt"))
    ref = cost_at(curve, reference).select("total_cost").scalar()
    scale = round(months / test_share)
    saving = F.col("cost_ref") - F.col("cost_opt")
    return best.withColumn("cost_ref", ref).select(
        "optimal_threshold", "cost_ref", "cost_opt", saving.alias("test_period_cost_saving"),
        (saving * F.lit(scale)).alias("annualized_cost_saving"))


def pr_curve(scored: DataFrame, score: str = "risk_score", label: str = "default_next_month",
             rows_per_block: int = 1_000_000) -> DataFrame:
    """threshold, precision, recall, tp at each distinct score (descending)."""
    r = running_sums(scored, score, {"n": F.lit(1), "tp": F.col(label)}, descending=True,
                     rows_per_block=rows_per_block)
    positives = scored.agg(F.sum(label)).scalar()
    return r.select(F.col(score).alias("threshold"),
                    (F.col("tp_cum") / F.col("n_cum")).alias("precision"),
                    F.try_divide(F.col("tp_cum"), positives).alias("recall"),
                    F.col("tp").alias("tp"))


def average_precision(scored: DataFrame, score: str = "risk_score", label: str = "default_next_month",
                      rows_per_block: int = 1_000_000) -> DataFrame:
    """Sum over distinct scores of (recall step) x (precision there)."""
    r = running_sums(scored, score, {"n": F.lit(1), "tp": F.col(label)}, descending=True,
                     rows_per_block=rows_per_block)
    term = F.col("tp").cast("double") * F.col("tp_cum").cast("double") / F.col("n_cum").cast("double")
    return r.agg(F.try_divide(F.sum(term), F.sum("tp")).alias("average_precision"))  # NULL without positives


def confusion(scored: DataFrame, t: float, score: str = "risk_score", label: str = "default_next_month") -> DataFrame:
    """tn, fp, fn, tp at threshold t (positive when score >= t)."""
    p = F.col(score) >= F.lit(t)
    y = F.col(label) == 1
    return scored.agg(F.count_if(~p & ~y).alias("tn"), F.count_if(p & ~y).alias("fp"),
                      F.count_if(~p & y).alias("fn"), F.count_if(p & y).alias("tp"))


def _div(a, b):
    return F.when(b != 0, a / b).otherwise(F.lit(0.0))


def fbeta(conf: DataFrame, beta: float = 2.0) -> DataFrame:
    b2 = beta * beta
    tp, fn, fp = F.col("tp").cast("double"), F.col("fn").cast("double"), F.col("fp").cast("double")
    return conf.select("*", _div((1 + b2) * tp, (1 + b2) * tp + b2 * fn + fp).alias("fbeta"))


def classification_report(conf: DataFrame) -> DataFrame:
    """Per class precision / recall / f1 / support, accuracy, macro and
    weighted averages.  A zero denominator gives 0."""
    tn, fp, fn, tp = [F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp")]
    n = tn + fp + fn + tp
    p0, r0 = _div(tn, tn + fn), _div(tn, tn + fp)
    p1, r1 = _div(tp, tp + fp), _div(tp, tp + fn)
    f0, f1 = _div(2 * p0 * r0, p0 + r0), _div(2 * p1 * r1, p1 + r1)
    s0, s1 = tn + fp, tp + fn
    acc = _div(tn + tp, n)
    rows = [
        ("0", p0, r0, f0, s0),
        ("1", p1, r1, f1, s1),
        ("accuracy", acc, acc, acc, n),
        ("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n),
        ("weighted avg", _div(p0 * s0 + p1 * s1, n), _div(r0 * s0 + r1 * s1, n), _div(f0 * s0 + f1 * s1, n), n),
    ]
    structs = [F.struct(F.lit(k).alias("class_name"), p.alias("precision"), r.alias("recall"), f.alias("f1_score"),
                        s.cast("long").alias("support")) for k, p, r, f, s in rows]
    return conf.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def class_weights(df: DataFrame, label: str = "default_next_month") -> DataFrame:
    """label, n, balanced weight n / (classes x n_label), imbalance n0 / n1."""
    g = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy()  # bounded: one row per class
    total = F.sum("n").over(whole)
    classes = F.count(F.lit(1)).over(whole)
    n0 = F.sum(F.when(F.col(label) == 0, F.col("n"))).over(whole)
    n1 = F.sum(F.when(F.col(label) == 1, F.col("n"))).over(whole)
    return g.select(label, "n", (total / (classes * F.col("n"))).alias("weight"),
                    (n0 / n1).alias("imbalance_ratio"))


def score_distribution(scores: DataFrame, edges: list[float] | None = None, score: str = "risk_score",
                       label: str = "default_next_month", key: str = "customer_id") -> DataFrame:
    """Accounts and defaults in right-closed score bins (lowest edge included);
    empty bins are kept with zeros; rate = defaults / accounts x 100, 0 when
    the bin is empty."""
    edges = edges or score_bins()
    k = len(edges) - 1
    b = scores.select(right_closed_bin(score, edges).alias("bin"), F.col(label).alias("y"), F.col(key))
    counts = b.groupBy("bin").agg(F.count(key).alias("account_count"), F.sum("y").alias("default_count"))
    all_bins = scores.sparkSession.range(1, k + 1).select(F.col("id").cast("int").alias("bin"))
    j = all_bins.join(counts, "bin", "left").na.fill(0, ["account_count", "default_count"])
    rate = F.when(F.col("account_count") > 0,
                  F.col("default_count").cast("double") / F.col("account_count") * 100).otherwise(F.lit(0.0))
    return j.select(interval_label(edges, F.col("bin")).alias("risk_score_bucket"),
                    F.col("account_count").cast("long").alias("account_count"),
                    F.col("default_count").cast("long").alias("default_count"),
                    rate.alias("default_rate_pct"))
