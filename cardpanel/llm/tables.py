"""Reading the tables and keeping intermediate results in the shared folder."""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Callable
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardpanel.session import checkpoint_dir


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, tag: str, by: str | None = None, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` once as Parquet into the shared checkpoint folder and read
    it back: later steps (and recomputation after a lost executor) start there.
    With ``by``, a filter on that column reads its rows' files alone; ``options``
    are those of the writer."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm/{tag}-{uuid.uuid4().hex}"
    writer = df.write.options(**(options or {}))
    (writer.partitionBy(by) if by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of an Arrow batch of whole texts.  A task holds a batch several times over, in Spark and in Python.
BATCH_BYTES = 2 << 20
#: Rows that Spark's Parquet reader decodes at a time.  Its buffer of 4096 whole texts is an
#: array of many MB, made anew for each file, for which the heap grows.
READER_ROWS = 256


def small_batches(spark: SparkSession) -> None:
    """Rows are read in batches of ``READER_ROWS`` and go to Python in batches of about
    ``BATCH_BYTES``, however many rows that is (smaller limits stay).  Each batch holds
    whole rows, so results do not change."""
    for key, most in (("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES), ("spark.sql.parquet.columnarReaderBatchSize", READER_ROWS)):
        now = spark.conf.get(key).removesuffix("b")
        if not now.isdigit() or int(now) > most:
            spark.conf.set(key, str(most))


def text_of(col: str = "text") -> Column:
    """The text with null read as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def fold_of(col: str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod`` (null id: -1)."""
    return F.coalesce(F.crc32(F.col(col).cast("string")) % mod, F.lit(-1)).cast("int")


def apart(documents: DataFrame, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``work``, whose own columns all begin with an underscore, on ``documents``; columns
    whose names do so, too, are packed into one meanwhile, so that none meets another.
    The result has the columns of ``documents``."""
    quoted = lambda names: [F.col(f"`{c}`") for c in names]
    hidden = [c for c in documents.columns if c.startswith("_")]
    if not hidden:
        return work(documents).select(*quoted(documents.columns))
    rows = documents.select(*quoted([c for c in documents.columns if c not in hidden]), F.struct(*quoted(hidden)).alias("_others"))
    return work(rows).select(*[F.col("_others").getField(c).alias(c) if c in hidden else F.col(f"`{c}`") for c in documents.columns])


def about(df: DataFrame, key: str, n: int, salt: str) -> DataFrame:
    """About ``n`` rows of ``df``: those whose hashed key falls into a share of
    n / rows (all rows where there are no more).  No sort, and equal keys stay
    together, so a rerun draws the same rows."""
    share = int(min(1.0, n / max(df.count(), 1)) * (1 << 30))
    return df.filter(F.pmod(F.xxhash64(F.col(key), F.lit(salt)), F.lit(1 << 30)) < share)


def in_task(spark: SparkSession, work: Callable[[Any], Any], data: Any) -> Any:
    """``work(data)`` in one task (numpy is single-threaded there, and the driver
    stays free).  For fits on samples of a bounded size."""
    shared = spark.sparkContext.broadcast(data)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(work(shared.value))], pa.binary())], ["out"])

    return pickle.loads(spark.range(0, 1, 1, 1).mapInArrow(run, "out binary").first()["out"])
