"""File sources and sinks.

* ``read_accounts``: CSV with a header line that is skipped; columns are bound
  by POSITION to the declared wide schema (header names are ignored, as a
  COPY into a typed staging table does), as text.  ``load_accounts`` types them
  and decides once per record whether it is good; ``split_records`` splits.
* ``write_table``: Parquet by default; CSV with a header for exports.
  Only ``small=True`` exports are written as one file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardpanel.operators.quality import violated
from cardpanel.schema import ACCOUNT_RULES, WIDE_SCHEMA, Rule
from cardpanel.session import stored

# Raw header names that get a new name on load.
RAW_RENAMES = {"default payment next month": "default.payment.next.month"}


EXTRA = "_extra"
#: Name of the column with the reasons for which a record is rejected.
REASONS = "reasons"


def read_accounts(spark: SparkSession, path: str, schema: T.StructType = WIDE_SCHEMA) -> DataFrame:
    """The file's fields as text, bound by position, with whatever follows the
    last declared field in ``_extra``."""
    fields = [T.StructField(f.name, T.StringType(), True) for f in schema.fields] + [T.StructField(EXTRA, T.StringType(), True)]
    return (spark.read.schema(T.StructType(fields)).option("header", True).option("enforceSchema", True)
            .option("mode", "PERMISSIVE").csv(path))


def _typed(name: str, dtype: T.DataType) -> tuple[Column, Column]:
    """(the field at its declared type, whether the text says something else).
    Digits that the type would round away count as something else."""
    text = F.trim(F.col(name))
    value = text.try_cast(dtype)
    exact = F.coalesce(text.try_cast("decimal(38,18)") == value.cast("decimal(38,18)"), F.lit(False))
    return value, text.isNotNull() & ~exact


def load_accounts(raw: DataFrame, schema: T.StructType = WIDE_SCHEMA, rules: list[Rule] = ACCOUNT_RULES) -> DataFrame:
    """One decision per record: ``reasons`` lists every field whose text is not of
    its type, every broken rule, and surplus fields; it is empty for good records."""
    values, wrong = {}, []
    for f in schema.fields:
        value, bad = _typed(f.name, f.dataType)
        values[f.name] = value
        wrong.append(F.when(bad, F.lit(f"{f.name} is not {f.dataType.simpleString()}")))
    names = [f.name for f in schema.fields]
    typed = raw.select(*[values[n].alias(n) for n in names], F.array(*wrong, F.when(F.col(EXTRA).isNotNull(), F.lit("surplus fields"))).alias("_wrong"))
    broken = F.array(*[F.when(violated(r), F.lit(r.name)) for r in rules])
    return typed.select(*names, F.array_compact(F.concat("_wrong", broken)).alias(REASONS))


def reasons_of(schema: T.StructType = WIDE_SCHEMA, rules: list[Rule] = ACCOUNT_RULES) -> list[str]:
    """Every reason that ``load_accounts`` can give."""
    return [*(f"{f.name} is not {f.dataType.simpleString()}" for f in schema.fields), "surplus fields", *(r.name for r in rules)]


def load_once(loaded: DataFrame, reasons: list[str]) -> tuple[DataFrame, dict[str, int]]:
    """(the records, stored; accepted and rejected records and records of each reason).
    The counts are taken by the write's own pass, so the file is parsed once."""
    seen = Observation()
    counts = [F.count_if(F.size(REASONS) == 0).alias("accepted"), F.count_if(F.size(REASONS) > 0).alias("rejected")]
    counts += [F.count_if(F.array_contains(REASONS, r)).alias(f"reason_{i}") for i, r in enumerate(reasons)]
    kept = stored(loaded.observe(seen, *counts))
    found = seen.get
    return kept, {"accepted": found["accepted"], "rejected": found["rejected"]} | {
        r: found[f"reason_{i}"] for i, r in enumerate(reasons) if found[f"reason_{i}"]}


def split_records(loaded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good records, rejected records with their reasons)."""
    return loaded.filter(F.size(REASONS) == 0).drop(REASONS), loaded.filter(F.size(REASONS) > 0)


def normalise_columns(df: DataFrame, renames: dict[str, str] = RAW_RENAMES) -> DataFrame:
    """Rename raw header names, then strip surrounding blanks from every name."""
    return df.toDF(*[renames.get(c, c).strip() for c in df.columns])


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
        if schema is None:
            reader = reader.option("inferSchema", True)
    return reader.format(fmt).load(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system of the path (works for
    local, HDFS and object-store paths alike)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", small: bool = False,
                partition_by: list[str] | None = None) -> str:
    """Write a table; ``small`` coalesces to one file (only for bounded exports)."""
    out = df.coalesce(1) if small else df
    w = out.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)
    return path


def copy_if_exists(spark: SparkSession, src: str, dst: str, fmt: str = "csv", small: bool = True) -> DataFrame:
    """Copy a table if its source exists; returns a one-row report either way."""
    if path_exists(spark, src):
        write_table(read_table(spark, src, fmt), dst, fmt, small=small)
        status = "copied"
    else:
        status = "skipped"
    return spark.createDataFrame([(src, dst, status)], "source string, target string, status string")


def write_metrics(df: DataFrame, path: str) -> str:
    df.coalesce(1).write.mode("overwrite").json(path)
    return path


def with_load_ts(df: DataFrame, col: str = "created_at") -> DataFrame:
    """Load timestamp default (evaluated once per query)."""
    return df.withColumn(col, F.current_timestamp())
