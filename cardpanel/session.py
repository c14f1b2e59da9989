"""Session construction and lineage cutting.

On a cluster the shared checkpoint folder comes from ``spark.checkpoint.dir``
(set by whoever runs the cluster).  Only a local-mode session without that
setting (tests, benchmarks on one machine) gets a private scratch folder.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Session settings for local runs.
LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "cardpanel",
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(LOCAL_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, registering it with the context.

    Reads ``spark.checkpoint.dir`` from the session.  If it is unset and the
    session runs in local mode, a fresh scratch folder is created (tests);
    on a cluster an unset value is an error, because a machine-local folder
    would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        conf_dir = tempfile.mkdtemp(prefix="cardpanel-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return conf_dir


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never a local one)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet into the shared folder and read back."""
    import uuid

    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/rows/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``cardpanel`` importable in executor Python workers (needed where a
    pandas function refers to package code), once per application: the
    package is zipped and distributed with ``addPyFile``."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import os
    import zipfile

    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="cardpanel-py-"), "cardpanel.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)


def store_table(df: DataFrame, name: str, bucket_by: list[str] | None = None, sort_by: list[str] | None = None,
                buckets: int | None = None) -> DataFrame:
    """Write ``df`` once as a Parquet table under the shared checkpoint folder
    and return it re-read.  With ``bucket_by`` the table is bucketed (same
    hash as a shuffle), so later joins, aggregations and windows on that key
    read it without shuffling it again.  ``buckets`` defaults to the shuffle
    partition count, so the other side of a join lines up with the buckets."""
    import uuid

    spark = df.sparkSession
    base = checkpoint_dir(spark).rstrip("/")
    table = f"cardpanel_{name}_{uuid.uuid4().hex[:12]}"
    writer = df.write.mode("overwrite").format("parquet").option("path", f"{base}/tables/{table}")
    if bucket_by:
        n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        writer = writer.bucketBy(n, *bucket_by)
        if sort_by:
            writer = writer.sortBy(*sort_by)
    writer.saveAsTable(table)
    out = spark.table(table)
    out._cardpanel_table = (table, f"{base}/tables/{table}")
    return out


def drop_table(df: DataFrame) -> None:
    """Drop a table made by ``store_table`` and its files (other frames: nothing)."""
    table, path = getattr(df, "_cardpanel_table", (None, None))
    if table:
        spark = df.sparkSession
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


# Target bytes per task for scans and shuffles.
TARGET_PARTITION_BYTES = 128 * 1024 * 1024


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size on storage of the given files or folders (Hadoop FS)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        if fs.exists(path):
            total += fs.getContentSummary(path).getLength()
    return total


def partitions_for(spark: SparkSession, paths: list[str], target: int = TARGET_PARTITION_BYTES) -> int:
    """Partitions of about ``target`` bytes of the input, never fewer than cores."""
    return max(spark.sparkContext.defaultParallelism, -(-input_bytes(spark, paths) // target))


def size_for_input(spark: SparkSession, paths: list[str], target: int = TARGET_PARTITION_BYTES) -> dict[str, str]:
    """Scan split size and shuffle partition count for the input size: about
    ``target`` bytes per task (partitions fit executor memory, spills stay
    small), never fewer partitions than cores.  AQE still coalesces small
    shuffles and splits skewed ones at run time.  Returns the settings applied."""
    settings = {
        "spark.sql.files.maxPartitionBytes": str(target),
        "spark.sql.shuffle.partitions": str(partitions_for(spark, paths, target)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    return settings
