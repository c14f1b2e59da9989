"""Monthly batch re-scoring as an incremental file stream.

New statement files (monthly panel rows) land in a folder.  A Structured
Streaming query with ``Trigger.AvailableNow`` picks up every file not yet
seen, and ``foreachBatch`` for each micro-batch:

1. upserts the statements into the stored panel (key customer_id, month): only the
   customer buckets that the batch touches are read and rewritten;
2. recomputes features and tiers for the accounts touched by the batch only
   (semi join of the panel with the batch keys; one aggregation);
3. writes (customer_id, tier, reason, features) as partition
   ``batch_id=<epoch>`` of the scores table.

Progress (which files are done) lives in the checkpoint location under the
shared checkpoint folder, so a re-run after a failure resumes without
double-processing; an upsert that is run again changes nothing, and the scores'
write is an overwrite keyed by the epoch, so a replayed batch gives the same result.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardpanel.operators.features import credit_features
from cardpanel.operators.tiers import assign_tiers
from cardpanel.schema import PANEL_SCHEMA
from cardpanel.session import checkpoint_dir
from cardpanel.sources.tables import read_stored, upsert_stored

KEYS = ["customer_id", "month_number"]
UPDATE = ["bill_amount", "pay_amount", "payment_status"]


def current_panel(spark: SparkSession, root: str) -> DataFrame:
    """The stored panel; empty when there is none."""
    return read_stored(spark, root, PANEL_SCHEMA)


def score_batch(batch: DataFrame, epoch: int, customers: DataFrame, panel_root: str, scores_path: str) -> None:
    """Upserts a batch into the panel and scores the accounts that it touches."""
    spark = batch.sparkSession
    batch = batch.distinct()  # the same statement delivered twice is one; differing ones raise
    upsert_stored(batch, panel_root, PANEL_SCHEMA, KEYS, UPDATE, bucket_by="customer_id")
    touched = batch.select("customer_id").distinct()
    acc = customers.join(touched, "customer_id", "left_semi")
    feats = credit_features(current_panel(spark, panel_root).join(touched, "customer_id", "left_semi"), acc)
    out = assign_tiers(feats, keep_features=True).withColumn("batch_id", F.lit(epoch))
    out.write.mode("overwrite").parquet(f"{scores_path}/batch_id={epoch}")


def start(spark: SparkSession, incoming: str, customers: DataFrame, panel_root: str, scores_path: str,
          name: str = "monthly_scoring"):
    """Process every statement file present now, then stop (scheduled batch)."""
    ckpt = os.path.join(checkpoint_dir(spark), f"stream-{name}")
    stream = spark.readStream.schema(PANEL_SCHEMA).option("recursiveFileLookup", "true").parquet(incoming)
    q = (stream.writeStream.queryName(name).option("checkpointLocation", ckpt)
         .foreachBatch(lambda df, epoch: score_batch(df, epoch, customers, panel_root, scores_path))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
