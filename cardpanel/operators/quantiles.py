"""Exact quantiles of many columns by class, without sorting the rows.

1. One aggregation keeps a mergeable sketch (``percentile_approx``) of every column
   and class.  A value a little below and one a little above each wanted quantile
   bracket it.
2. One pass counts exactly how many values lie below each bracket, and one how often
   each value inside occurs: some ten-thousandths of the rows, whatever their number.
   While a bracket still holds more than ``INSIDE`` different values, it is narrowed
   by a sketch of those.
3. Running counts inside the brackets give the order statistics.

A bracket that misses its order statistic (which the sketch's bound rules out) is
widened and counted again, so the result never depends on the sketch's error.
"""

from __future__ import annotations

from math import ceil, floor

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardpanel.session import stored

#: Error of the sketch is 1 / ACCURACY of the rows; brackets reach MARGIN times that to either side.
ACCURACY, MARGIN = 2000, 3
#: Different values that a bracket may hold when it is ranked.
INSIDE = 200_000


def class_quantiles(df: DataFrame, names: list[str], label: str, probs: tuple[float, ...]) -> dict[tuple, tuple[int, list[float]]]:
    """(class, column) -> (values, quantiles by linear interpolation); nulls don't count.
    Memory on the driver: classes x columns x quantiles."""
    margin = MARGIN
    while True:
        spots = _brackets(df, names, label, probs, margin / ACCURACY)
        found = _order_statistics(df, names, label, spots)
        if found is not None:
            break
        margin *= 8
    out: dict[tuple, tuple[int, list[float]]] = {}
    for (c, name), (n, _) in spots.items():
        values = []
        for q in probs:
            h = q * (n - 1)
            lo, hi = found[c, name, floor(h)], found[c, name, ceil(h)]
            values.append(lo + (h - floor(h)) * (hi - lo))
        out[c, name] = n, values
    return out


def _brackets(df: DataFrame, names: list[str], label: str, probs: tuple[float, ...], margin: float) -> dict[tuple, tuple[int, list]]:
    """(class, column) -> (values, [(low, high, wanted positions)])."""
    shares = [min(max(q + d, 0.0), 1.0) for q in probs for d in (-margin, margin)]
    aggs = [F.percentile_approx(F.col(c).cast("double"), shares, ACCURACY).alias(f"b_{i}") for i, c in enumerate(names)]
    aggs += [F.count(c).alias(f"n_{i}") for i, c in enumerate(names)]
    out = {}
    for r in df.groupBy(label).agg(*aggs).collect():  # one row a class
        for i, c in enumerate(names):
            n = r[f"n_{i}"]
            if n:
                edges = r[f"b_{i}"]
                spots = [sorted({floor(q * (n - 1)), ceil(q * (n - 1))}) for q in probs]
                # at the ends of the distribution the bracket is open
                low = [None if q <= margin else edges[2 * j] for j, q in enumerate(probs)]
                high = [None if q >= 1 - margin else edges[2 * j + 1] for j, q in enumerate(probs)]
                out[r[label], c] = n, list(zip(low, high, spots))
    return out


def _order_statistics(df: DataFrame, names: list[str], label: str, spots: dict[tuple, tuple[int, list]]) -> dict[tuple, float] | None:
    """(class, column, position) -> value, or None where a bracket misses one."""
    if not spots:
        return {}
    slots = [(c, j) for c in names for j in range(len(next(iter(spots.values()))[1]))]
    classes = list(dict.fromkeys(c for c, _ in spots))
    rows = [(c, *[x for name, j in slots for x in (spots[c, name][1][j][:2] if (c, name) in spots else (None, None))]) for c in classes]
    edges = [f"__{side}_{i}" for i in range(len(slots)) for side in ("lo", "hi")]
    kind = df.schema[label].dataType.simpleString()
    table = df.sparkSession.createDataFrame(rows, f"__class {kind}, " + ", ".join(f"{e} double" for e in edges))
    met = df.select(label, *[F.col(c).cast("double").alias(c) for c in names]).join(table, F.col(label).eqNullSafe(F.col("__class")))
    lo, hi = (lambda i: F.col(f"__lo_{i}")), (lambda i: F.col(f"__hi_{i}"))
    below = met.groupBy(label).agg(*[F.count_if(F.col(c) < lo(i)).alias(f"b_{i}") for i, (c, _) in enumerate(slots)]).collect()
    before = {(r[label], i): r[f"b_{i}"] for r in below for i in range(len(slots))}
    inside = lambda i, c: F.coalesce(F.col(c) >= lo(i), F.col(c).isNotNull()) & F.coalesce(F.col(c) <= hi(i), F.lit(True))
    hits = F.array(*[F.when(inside(i, c), F.struct(F.lit(i).alias("i"), F.col(c).alias("v"))) for i, (c, _) in enumerate(slots)])
    held = met.select(label, F.explode(F.filter(hits, lambda x: x.isNotNull())).alias("x"))
    held = stored(held.groupBy(label, F.col("x.i").alias("i"), F.col("x.v").alias("v")).agg(F.count(F.lit(1)).alias("n")))
    wanted = {(c, i): (spots[c, name][1][j][2]) for i, (name, j) in enumerate(slots) for c in classes if (c, name) in spots}
    held, before = _narrowed(held, label, before, wanted)
    w = Window.partitionBy(label, "i").orderBy("v")  # at most INSIDE rows each
    ranked = held.withColumn("upto", F.sum("n").over(w))
    want = [(c, i, p - before[c, i], p) for (c, i), ps in wanted.items() for p in ps]
    if any(at < 0 for _, _, at, _ in want):
        return None
    marks = df.sparkSession.createDataFrame(want, f"__class {kind}, __i int, at long, position long")
    found = ranked.join(marks, F.col(label).eqNullSafe(F.col("__class")) & (F.col("i") == F.col("__i")) & (F.col("upto") - F.col("n") <= F.col("at")) & (F.col("at") < F.col("upto")))
    out = {(r[label], slots[r["i"]][0], r["position"]): r["v"] for r in found.select(label, "i", "position", "v").collect()}
    return out if len(out) == len({(c, slots[i][0], p) for c, i, _, p in want}) else None


def _narrowed(held: DataFrame, label: str, before: dict, wanted: dict) -> tuple[DataFrame, dict]:
    """Cuts the values that can't be wanted out of brackets that hold too many."""
    while True:
        size = {(r[label], r["i"]): r["count"] for r in held.groupBy(label, "i").count().collect()}
        if max(size.values(), default=0) <= INSIDE:
            return held, before
        # values are distinct here: cut at approximate quantiles of them and count exactly what each slice holds
        cuts = {(r[label], r["i"]): r["c"] for r in held.groupBy(label, "i").agg(F.percentile_approx("v", [k / 64 for k in range(1, 64)], ACCURACY).alias("c")).collect()}
        kind = held.schema[label].dataType.simpleString()
        table = held.sparkSession.createDataFrame([(c, i, x) for (c, i), x in cuts.items()], f"__class {kind}, __i int, cuts array<double>")
        on = F.col(label).eqNullSafe(F.col("__class")) & (F.col("i") == F.col("__i"))
        sliced = stored(held.join(table, on).withColumn("slice", F.size(F.filter("cuts", lambda x: x < F.col("v")))).drop("__class", "__i", "cuts"))
        counts: dict[tuple, dict[int, int]] = {}
        for r in sliced.groupBy(label, "i", "slice").agg(F.sum("n").alias("n")).collect():
            counts.setdefault((r[label], r["i"]), {})[r["slice"]] = r["n"]
        keep, before = [], dict(before)
        for key, by in counts.items():
            at, first, last = before[key], None, None
            for s in sorted(by):
                if any(at <= p < at + by[s] for p in wanted[key]):
                    first, last = (s if first is None else first), s
                if first is None:
                    before[key] = at + by[s]
                at += by[s]
            if first is None:
                before[key], first, last = at, 0, -1
            keep.append((*key, first, last))
        spans = held.sparkSession.createDataFrame(keep, f"__class {kind}, __i int, __first int, __last int")
        held = stored(sliced.join(spans, on).filter(F.col("slice").between(F.col("__first"), F.col("__last"))).select(label, "i", "v", "n"))
