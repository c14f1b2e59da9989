"""Tables that are rewritten in part or as a whole while others read them.

* ``refresh``: a full refresh goes to a new version folder ``v=<n>``; Spark writes its
  ``_SUCCESS`` file when all tasks have committed, and that file is the switch:
  ``current`` reads the highest version that has one.  A job killed while it writes
  leaves the version before as it was.
* ``upsert_stored``: rows lie in buckets of the hashed keys (partition folders).  An
  upsert reads, merges and rewrites (dynamic partition overwrite) only the buckets that
  its source touches; the others' files stay.  Merged rows are written to the shared
  folder first, so nothing is read from a folder that is being replaced, and an upsert
  that is run again gives the same table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardpanel.session import stored
from cardpanel.sources.files import path_exists
from cardpanel.sources.upsert import check_unique_source, upsert

BUCKETS, BUCKET = 64, "__bucket"
#: Versions that stay after a refresh, for readers that have begun.
KEPT = 2


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def versions(spark: SparkSession, root: str, complete: bool = True) -> list[int]:
    """Version numbers under ``root``, ascending; ``complete``: those whose write ended."""
    path, fs = _fs(spark, root)
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]
    found = sorted(int(n[2:]) for n in names if n.startswith("v=") and n[2:].isdigit())
    return [v for v in found if not complete or path_exists(spark, f"{root}/v={v}/_SUCCESS")]


def refresh(df: DataFrame, root: str) -> int:
    """Replaces the table as a whole; returns its new version."""
    spark = df.sparkSession
    new = max(versions(spark, root, complete=False), default=0) + 1
    df.write.parquet(f"{root}/v={new}")
    done = versions(spark, root)
    for v in versions(spark, root, complete=False):
        if v < new and v not in done[-KEPT:]:
            path, fs = _fs(spark, f"{root}/v={v}")
            fs.delete(path, True)
    return new


def current(spark: SparkSession, root: str) -> DataFrame:
    """The table as of its last complete refresh."""
    done = versions(spark, root)
    if not done:
        raise FileNotFoundError(f"no complete version under {root}")
    return spark.read.parquet(f"{root}/v={done[-1]}")


def read_stored(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The rows of a bucketed table, empty where there is none yet."""
    return _bucketed(spark, root, schema).drop(BUCKET)


def _bucketed(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    whole = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
    return spark.read.schema(whole).parquet(root) if path_exists(spark, root) else spark.createDataFrame([], whole)


def upsert_stored(source: DataFrame, root: str, schema: T.StructType, keys: list[str], update_cols: list[str], bucket_by: str | None = None,
                  buckets: int = BUCKETS, validate: bool = True) -> list[int]:
    """Upserts ``source`` into the table under ``root``; returns the buckets rewritten.
    ``bucket_by``: the key column whose hash deals the rows (default: the first)."""
    spark = source.sparkSession
    if validate:
        check_unique_source(source, keys)
    bucket = F.pmod(F.xxhash64(F.col(bucket_by or keys[0])), F.lit(buckets)).cast("int")
    source = source.select(*schema.fieldNames())
    touched = sorted(r[0] for r in source.select(bucket).distinct().collect())  # at most ``buckets`` numbers
    if not touched:
        return []
    target = _bucketed(spark, root, schema).filter(F.col(BUCKET).isin(touched)).drop(BUCKET)
    merged = stored(upsert(target, source, keys, update_cols, validate=False).withColumn(BUCKET, bucket))
    out = merged.repartition(len(touched), BUCKET)  # a bucket's rows are one file
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(root)
    return touched
