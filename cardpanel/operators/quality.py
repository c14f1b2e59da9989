"""Data-quality operators: declarative rules, keys, profiles.

Every rule set is evaluated in ONE pass over its table (a ``count_if`` per
rule in a single aggregation), then unpivoted to one row per rule.  Key checks
are a ``groupBy(keys)`` (partial aggregation first, so a hot key costs one
row per map task) and an anti join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardpanel.schema import Rule, number_text


def rule_sql(rule: Rule, quote: str = "`") -> str:
    """The rule as a SQL predicate (Spark SQL with backticks, ANSI with
    ``quote='"'``).  TRUE or NULL means the row passes, except for ``not_null``."""
    c = f"{quote}{rule.column}{quote}"
    if rule.kind == "not_null":
        return f"{c} IS NOT NULL"
    if rule.kind == "range":
        parts = []
        if rule.lo is not None and rule.lo != float("-inf"):
            parts.append(f"{c} >= {number_text(rule.lo)}")
        if rule.hi is not None and rule.hi != float("inf"):
            parts.append(f"{c} <= {number_text(rule.hi)}")
        return " AND ".join(parts) or "TRUE"
    if rule.kind == "domain":
        vals = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in rule.values)
        return f"{c} IN ({vals})"
    if rule.kind == "scale":
        # the value must equal itself at the declared precision: no digit is rounded away
        text = f"CAST({c} AS STRING)"
        fits = f"TRY_CAST({text} AS DECIMAL({rule.precision},{rule.scale})) = TRY_CAST({text} AS DECIMAL(38,18))"
        return f"({c} IS NULL OR COALESCE({fits}, FALSE))"
    raise ValueError(f"unknown rule kind {rule.kind}")


def violated(rule: Rule) -> Column:
    """TRUE only when the row breaks the rule (NULL predicate passes)."""
    return F.coalesce(~F.expr(rule_sql(rule)), F.lit(False))


def check(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """table_name, rule, violations - one aggregation pass for all rules."""
    aggs = [F.count_if(violated(r)).alias(f"r{i}") for i, r in enumerate(rules)]
    wide = df.agg(*aggs)
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(r.table).alias("table_name"), F.lit(r.name).alias("rule"), F.col(f"r{i}").alias("violations"))
        for i, r in enumerate(rules)])).alias("v")).select("v.*")


def enforce(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds ``violations``: names of the broken rules (empty array = good row).
    ``good(df)`` / ``rejected(df)`` split on it."""
    names = F.array(*[F.when(violated(r), F.lit(r.name)) for r in rules])
    return df.withColumn("violations", F.filter(names, lambda x: x.isNotNull()))


def good(enforced: DataFrame) -> DataFrame:
    return enforced.filter(F.size("violations") == 0).drop("violations")


def rejected(enforced: DataFrame) -> DataFrame:
    return enforced.filter(F.size("violations") > 0)


def enforce_summary(df: DataFrame, rules: list[Rule], table: str) -> DataFrame:
    e = enforce(df, rules)
    bad = F.size("violations") > 0
    return e.agg(F.lit(table).alias("table_name"), F.count_if(~bad).alias("good_rows"),
                 F.count_if(bad).alias("rejected_rows"))


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their count (PK / UNIQUE)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def duplicate_summary(df: DataFrame, keys: list[str], table: str) -> DataFrame:
    d = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return d.agg(F.lit(table).alias("table_name"), F.lit(", ".join(keys)).alias("key_columns"),
                 F.count_if(F.col("n") > 1).alias("duplicate_keys"),
                 F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n") - 1)), F.lit(0)).cast("long").alias("excess_rows"))


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key has no parent row (FK), as a left anti join."""
    return child.join(parent.select(key).distinct(), key, "left_anti")


def orphan_summary(child: DataFrame, parent: DataFrame, key: str, table: str) -> DataFrame:
    return orphans(child, parent, key).agg(F.lit(table).alias("table_name"), F.count(F.lit(1)).alias("orphan_rows"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """UNION ALL of per-table counts (each count is its own aggregation)."""
    out = None
    for name, df in tables.items():
        c = df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows_loaded"))
        out = c if out is None else out.unionByName(c)
    return out


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row: <column>_nulls for each column, in one pass."""
    cols = columns or df.columns
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in cols])


def coded_zero_counts(customers: DataFrame) -> DataFrame:
    """Undocumented code 0 in education and marriage."""
    return customers.agg(F.count_if(F.col("education") == 0).alias("education_zero_records"),
                         F.count_if(F.col("marriage") == 0).alias("marriage_zero_records"))


def value_shares(df: DataFrame, col: str) -> DataFrame:
    """Count and share of each value of a column (share of all rows).  The
    grand total is a scalar subquery: evaluated once, no window over rows."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).withColumn("share", F.col("n") / total)


def shape_and_types(df: DataFrame, name: str) -> DataFrame:
    """(table_name, column_name, data_type, position) plus the row count."""
    spark = df.sparkSession
    meta = spark.createDataFrame([(name, c, t, i) for i, (c, t) in enumerate(df.dtypes)],
                                 "table_name string, column_name string, data_type string, position int")
    return meta.withColumn("rows", df.agg(F.count(F.lit(1))).scalar())
