"""Column expressions used across the operators.

Everything here is a plain ``Column`` built from ``pyspark.sql.functions``:
it stays inside whole-stage codegen, no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Delinquency bucket labels by status.
CURRENT, DPD30, DPD60, DPD90, DPD90P = "Current", "30-DPD", "60-DPD", "90-DPD", "90+-DPD"
STATUS_BUCKETS = [(CURRENT, None, 0), (DPD30, 1, 1), (DPD60, 2, 2), (DPD90, 3, 3), (DPD90P, 4, None)]
# On-time month bucket labels.
ON_TIME_BUCKETS = [("0-1", 0, 1), ("2-3", 2, 3), ("4-5", 4, 5), ("6", 6, 6)]
# Composite heuristic weights (utilization, worst status, drift).
COMPOSITE_WEIGHTS = (0.4, 0.3, 0.3)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def delinquency_bucket(status="payment_status", null_as_worst: bool = False) -> Column:
    """Five-state bucket of a payment status.

    SQL semantics (default): a NULL status gives a NULL bucket.  With
    ``null_as_worst`` a NULL falls through every test to ``90+-DPD``, as a chain
    of ``if`` statements does.
    """
    s = _c(status)
    expr = (F.when(s <= 0, CURRENT).when(s == 1, DPD30).when(s == 2, DPD60)
            .when(s == 3, DPD90))
    return expr.otherwise(DPD90P) if null_as_worst else expr.when(s >= 4, DPD90P)


def safe_divide(num, den) -> Column:
    """num / den, NULL when den is 0 (SQL NULLIF guard; no ANSI divide error)."""
    d = _c(den)
    return _c(num) / F.when(d != 0, d)


def guarded_ratio(num, den) -> Column:
    """num / den where den > 0, else 0 (the wide-record payment ratio)."""
    d = _c(den)
    return F.when(d > 0, _c(num) / d).otherwise(F.lit(0.0))


def composite_score(util="avg_utilization", worst="max_delinquency", drift="delinquency_drift",
                    weights=COMPOSITE_WEIGHTS, digits: int | None = 4) -> Column:
    wu, ww, wd = weights
    raw = (_c(util).cast("double") * F.lit(wu) + _c(worst).cast("double") * F.lit(ww)
           + _c(drift).cast("double") * F.lit(wd))
    return F.round(raw, digits) if digits is not None else raw


def heuristic_probability(util="avg_utilization", worst="max_delinquency", drift="delinquency_drift") -> Column:
    """Deterministic score in [0, 1): c / (1 + c), c = max(composite, 0).

    Stands in for a model probability wherever results must be reproducible
    by an independent SQL engine (evaluation operators, reports).
    """
    c = F.greatest(composite_score(util, worst, drift), F.lit(0.0))
    return c / (F.lit(1.0) + c)


def on_time_bucket(months="on_time_months") -> Column:
    m = _c(months)
    expr = None
    for label, lo, hi in ON_TIME_BUCKETS:
        cond = m.between(lo, hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr


def left_closed_bucket(value, lo: float, hi: float, n: int) -> Column:
    """SQL WIDTH_BUCKET: [lo, hi) in n equal buckets, 0 below, n+1 at or above hi."""
    return F.width_bucket(_c(value).cast("double"), F.lit(float(lo)), F.lit(float(hi)), F.lit(n)).cast("int")


def right_closed_bin(value, edges: list[float]) -> Column:
    """Index 1..k of the right-closed bin (e[i-1], e[i]] holding value; the
    lowest edge is included in bin 1.  NULL outside [e0, ek].

    Edges are literals, so this is a short CASE chain, not a join.
    """
    v = _c(value)
    expr = F.when(v < F.lit(edges[0]), F.lit(None).cast("int"))
    for i in range(1, len(edges)):
        expr = expr.when(v <= F.lit(edges[i]), F.lit(i))
    return expr


def interval_label(edges: list[float], index, lowest_included: bool = True, digits: int = 3) -> Column:
    """Text label ``(a, b]`` of a right-closed bin index (first bin shows the
    lowest edge lowered by 10^-digits when included, as interval labels do)."""
    labels = []
    for i in range(1, len(edges)):
        a, b = edges[i - 1], edges[i]
        if i == 1 and lowest_included:
            a = round(a - 10 ** -digits, digits)
        labels.append(f"({round(a, digits)!r}, {round(b, digits)!r}]")
    return F.element_at(F.array(*[F.lit(x) for x in labels]), _c(index))


def fx(amount, rate: float) -> Column:
    return _c(amount).cast("double") / F.lit(float(rate))


def as_pct(count, total) -> Column:
    """count x 100 / total; NULL when total is 0 (no ANSI divide error)."""
    return F.try_divide(_c(count) * F.lit(100.0), _c(total))


def pct_text(value, digits: int = 1) -> Column:
    return F.concat(F.format_number(_c(value), digits), F.lit("%"))


def money_text(value) -> Column:
    return F.concat(F.lit("$"), F.format_number(F.round(_c(value), 0), 0))
