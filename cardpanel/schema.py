"""Declared schemas, column comments and constraint rules of the portfolio model.

Spark does not enforce keys or CHECK constraints on files, so constraints are
kept as data (``Rule``) and evaluated by ``cardpanel.operators.quality``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)

# Names and code lists that outputs must carry verbatim.
FEATURES = [
    "avg_utilization",
    "utilization_trend",
    "on_time_months",
    "max_delinquency",
    "delinquency_drift",
    "consecutive_delays",
    "payment_ratio",
    "balance_volatility",
]
TIER_HIGH, TIER_MEDIUM, TIER_LOW = "High Risk", "Medium Risk", "Low Risk"
TIER_ORDER = [TIER_LOW, TIER_MEDIUM, TIER_HIGH]
BUCKETS = ["30-DPD", "60-DPD", "90+-DPD", "90-DPD", "Current"]  # byte order
MONTHS = 6
TWD_PER_USD = 31.0
STATUS_COLUMNS = ["pay_0", "pay_2", "pay_3", "pay_4", "pay_5", "pay_6"]  # source names, no pay_1


def _f(name: str, dtype: T.DataType, nullable: bool = True, comment: str | None = None) -> T.StructField:
    return T.StructField(name, dtype, nullable, {"comment": comment} if comment else {})


WIDE_SCHEMA = T.StructType(
    [_f("id", T.IntegerType()), _f("limit_bal", MONEY), _f("sex", T.ShortType()),
     _f("education", T.ShortType()), _f("marriage", T.ShortType()), _f("age", T.IntegerType())]
    + [_f(c, T.ShortType()) for c in STATUS_COLUMNS]
    + [_f(f"bill_amt{i}", MONEY) for i in range(1, MONTHS + 1)]
    + [_f(f"pay_amt{i}", MONEY) for i in range(1, MONTHS + 1)]
    + [_f("default_payment_next_month", T.ShortType())]
)

CUSTOMERS_SCHEMA = T.StructType([
    _f("customer_id", T.LongType(), False, "account key"),
    _f("credit_limit", MONEY, False, "approved limit in TWD, the exposure measure"),
    _f("sex", T.ShortType(), True, "1 male, 2 female"),
    _f("education", T.ShortType(), True, "1 graduate .. 4 other; 0, 5, 6 undocumented"),
    _f("marriage", T.ShortType(), True, "1 married, 2 single, 3 other; 0 undocumented"),
    _f("age", T.IntegerType(), True, "years"),
])

PANEL_SCHEMA = T.StructType([
    _f("customer_id", T.LongType(), False, "account key"),
    _f("month_number", T.IntegerType(), False, "statement index 1..6; 1 is the latest month"),
    _f("bill_amount", MONEY, True, "statement balance, TWD"),
    _f("pay_amount", MONEY, True, "amount paid, TWD"),
    _f("payment_status", T.IntegerType(), True, "-2 no use, -1 paid in full, 0 revolving, k>=1 months late"),
])

OUTCOMES_SCHEMA = T.StructType([
    _f("customer_id", T.LongType(), False, "account key"),
    _f("default_next_month", T.IntegerType(), False, "1 if the account defaulted the month after"),
])

FEATURES_SCHEMA = T.StructType(
    [_f("customer_id", T.LongType(), False, "account key")]
    + [_f(c, T.DoubleType() if c in ("avg_utilization", "utilization_trend", "payment_ratio", "balance_volatility")
          else T.IntegerType(), True) for c in FEATURES]
)

TIERS_SCHEMA = T.StructType([
    _f("customer_id", T.LongType(), False, "account key"),
    _f("risk_tier", T.StringType(), False, "High / Medium / Low Risk"),
    _f("tier_reason", T.StringType(), False, "first rule that matched"),
])


def with_comments(df, schema: T.StructType):
    """Attach the declared column comments to a DataFrame (C14)."""
    comments = {f.name: f.metadata.get("comment") for f in schema.fields if f.metadata.get("comment")}
    for name, text in comments.items():
        if name in df.columns:
            df = df.withMetadata(name, {"comment": text})
    return df


def number_text(x: float) -> str:
    """A bound in full: integers without a point, others as they are."""
    return str(int(x)) if float(x).is_integer() else repr(float(x))


@dataclass(frozen=True)
class Rule:
    """One declarative constraint.

    kind: ``not_null``, ``range`` (lo..hi inclusive), ``domain`` (values),
    ``scale`` (fits decimal(precision, scale)).  NULL passes every rule except
    ``not_null``, as a SQL CHECK does.
    """

    table: str
    column: str
    kind: str
    lo: float | None = None
    hi: float | None = None
    values: tuple = field(default_factory=tuple)
    precision: int | None = None
    scale: int | None = None

    @property
    def name(self) -> str:
        if self.kind == "range":
            lo_open = self.lo is None or self.lo == float("-inf")
            hi_open = self.hi is None or self.hi == float("inf")
            if hi_open and not lo_open:
                return f"{self.table}.{self.column} >= {number_text(self.lo)}"
            if lo_open and not hi_open:
                return f"{self.table}.{self.column} <= {number_text(self.hi)}"
            return f"{self.table}.{self.column} between {number_text(self.lo)} and {number_text(self.hi)}"
        if self.kind == "domain":
            return f"{self.table}.{self.column} in ({', '.join(str(v) for v in self.values)})"
        if self.kind == "scale":
            return f"{self.table}.{self.column} fits decimal({self.precision},{self.scale})"
        return f"{self.table}.{self.column} not null"


# The declared constraints of the model.
CUSTOMER_RULES = [
    Rule("customers", "customer_id", "not_null"),
    Rule("customers", "credit_limit", "not_null"),
    Rule("customers", "credit_limit", "range", 0, float("inf")),
    Rule("customers", "credit_limit", "scale", precision=12, scale=2),
    Rule("customers", "sex", "domain", values=(1, 2)),
    Rule("customers", "education", "range", 0, 6),
    Rule("customers", "marriage", "range", 0, 3),
    Rule("customers", "age", "range", 18, 100),
]
PANEL_RULES = [
    Rule("monthly_payments", "customer_id", "not_null"),
    Rule("monthly_payments", "month_number", "not_null"),
    Rule("monthly_payments", "month_number", "range", 1, 6),
    Rule("monthly_payments", "payment_status", "range", -2, 9),
    Rule("monthly_payments", "bill_amount", "scale", precision=12, scale=2),
    Rule("monthly_payments", "pay_amount", "scale", precision=12, scale=2),
]
OUTCOME_RULES = [
    Rule("outcomes", "customer_id", "not_null"),
    Rule("outcomes", "default_next_month", "not_null"),
    Rule("outcomes", "default_next_month", "domain", values=(0, 1)),
]
TIER_RULES = [
    Rule("risk_tiers", "risk_tier", "not_null"),
    Rule("risk_tiers", "risk_tier", "domain", values=(TIER_HIGH, TIER_MEDIUM, TIER_LOW)),
    Rule("risk_tiers", "tier_reason", "not_null"),
]
#: The same constraints on the wide source record.
ACCOUNT_RULES = [
    Rule("accounts", "id", "not_null"),
    Rule("accounts", "limit_bal", "not_null"),
    Rule("accounts", "limit_bal", "range", 0, float("inf")),
    Rule("accounts", "sex", "domain", values=(1, 2)),
    Rule("accounts", "education", "range", 0, 6),
    Rule("accounts", "marriage", "range", 0, 3),
    Rule("accounts", "age", "range", 18, 100),
    *[Rule("accounts", c, "range", -2, 9) for c in STATUS_COLUMNS],
    Rule("accounts", "default_payment_next_month", "not_null"),
    Rule("accounts", "default_payment_next_month", "domain", values=(0, 1)),
]
