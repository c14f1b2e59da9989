"""Feature attributions and per-account drivers.

Linear scorers (logistic regression, the composite heuristic) have exact
attributions coef_j * (x_j - mean_j): plain column arithmetic, the means being
one aggregation used as scalar subqueries.  Global importance is the mean
absolute attribution per feature; the top drivers of an account come from
sorting its own small array of (|attribution|, feature) structs - no shuffle.
Tree ensembles are handled in ``cardpanel.operators.treeshap``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardpanel.functions.columns import COMPOSITE_WEIGHTS
from cardpanel.schema import FEATURES

# The composite heuristic as a linear scorer.
COMPOSITE_COEFS = dict(zip(["avg_utilization", "max_delinquency", "delinquency_drift"], COMPOSITE_WEIGHTS))


def linear_attributions(df: DataFrame, coefs: dict[str, float], names=FEATURES, key: str = "customer_id") -> DataFrame:
    """Wide: key + one attribution column per feature (0 for features the
    scorer does not use)."""
    used = [n for n in names if coefs.get(n, 0.0) != 0.0]
    means = df.agg(*[F.avg(F.col(n).cast("double")).alias(n) for n in used]) if used else None
    cols = [F.col(key)]
    for n in names:
        if n in used:
            cols.append((F.lit(float(coefs[n])) * (F.col(n).cast("double") - means.select(n).scalar())).alias(n))
        else:
            cols.append(F.lit(0.0).alias(n))
    return df.select(*cols)


def attribution_importance(attr: DataFrame, names=FEATURES, digits: int | None = None) -> DataFrame:
    """feature_name, mean_abs_value, rank (1 = largest; ties by name)."""
    wide = attr.agg(*[F.avg(F.abs(F.col(n))).alias(n) for n in names])
    long = wide.unpivot([], list(names), "feature_name", "mean_abs_value")
    if digits is not None:
        long = long.withColumn("mean_abs_value", F.round("mean_abs_value", digits))
    w = Window.partitionBy().orderBy(F.col("mean_abs_value").desc(), F.col("feature_name").asc())  # 8 rows
    return long.withColumn("rank", F.row_number().over(w))


def top_k_by_abs(attr: DataFrame, names=FEATURES, k: int = 3, key: str = "customer_id",
                 prefix: str = "top_driver_") -> DataFrame:
    """Names of the k features with the largest |attribution| in each row.
    Ties: the feature later in ``names`` first (reverse of an ascending
    stable sort).  A per-row array sort: no shuffle, no window."""
    items = F.array(*[F.struct(F.abs(F.col(n)).alias("a"), F.lit(i).alias("i"), F.lit(n).alias("name"))
                      for i, n in enumerate(names)])
    ranked = F.array_sort(items, lambda x, y: F.when(x["a"] > y["a"], -1).when(x["a"] < y["a"], 1)
                          .when(x["i"] > y["i"], -1).when(x["i"] < y["i"], 1).otherwise(0))
    out = attr.select(F.col(key), ranked.alias("__r"))
    return out.select(F.col(key), *[F.col("__r")[i]["name"].alias(f"{prefix}{i + 1}") for i in range(k)])


def top_drivers(scores: DataFrame, attr: DataFrame, n: int = 20, names=FEATURES, key: str = "customer_id",
                score: str = "risk_score") -> DataFrame:
    """Top n accounts by score (ties: key) with their top-3 drivers."""
    top = scores.select(key, score).orderBy(F.col(score).desc(), F.col(key).asc()).limit(n)
    return top.join(top_k_by_abs(attr, names, 3, key), key)
