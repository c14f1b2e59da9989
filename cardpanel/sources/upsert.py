"""Key-based upsert (INSERT .. ON CONFLICT (keys) DO UPDATE SET <cols>).

Files carry no MERGE, so the upsert is one full outer join on the keys:
* key only in the source  -> inserted with the source values;
* key in both             -> the listed update columns take the source value
  (an explicit NULL in the source overwrites), every other column keeps the
  target value (a load timestamp is therefore kept from the first load);
* key only in the target  -> unchanged.
Two source rows with one key are an error, as in SQL; ``check_unique_source``
raises before the join runs.  Both sides shuffle once on the keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardpanel.operators.quality import duplicates


class DuplicateSourceKey(ValueError):
    pass


def check_unique_source(source: DataFrame, keys: list[str]) -> None:
    dup = duplicates(source, keys).limit(1).collect()
    if dup:
        raise DuplicateSourceKey(f"source has more than one row for key {dict(dup[0].asDict())}")


def upsert(target: DataFrame, source: DataFrame, keys: list[str], update_cols: list[str],
           created_col: str | None = None, validate: bool = True) -> DataFrame:
    if validate:
        check_unique_source(source, keys)
    present = "__src_present"
    t = target.alias("t")
    s = source.withColumn(present, F.lit(True)).alias("s")
    cond = None
    for k in keys:
        c = F.col(f"t.{k}") == F.col(f"s.{k}")
        cond = c if cond is None else cond & c
    j = t.join(s, cond, "full_outer")
    src_here = F.col(f"s.{present}").isNotNull()
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.coalesce(F.col(f"t.{c}"), F.col(f"s.{c}")).alias(c))
        elif c in update_cols:
            out.append(F.when(src_here, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        elif created_col is not None and c == created_col:
            now = F.current_timestamp().cast(target.schema[c].dataType)
            out.append(F.coalesce(F.col(f"t.{c}"), now).alias(c))
        elif c in source.columns:
            out.append(F.when(F.col(f"t.{keys[0]}").isNull(), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.col(f"t.{c}").alias(c))
    return j.select(*out)
