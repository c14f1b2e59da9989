"""Mixing sources to target weights, in fixed-length blocks of words.

1. Every source's words are laid out one after another and cut into blocks of
   ``block_words`` words (the last may be shorter).
2. Each source has a quota of block slots that brings it near its target; output
   shards draw multinomial source counts in turn, with chances in proportion to
   what is left of the quotas, so the last shard ends exactly on them.
3. Slot k of a source takes block P(k): whole passes over the source, each in the
   order of its own pseudorandom permutation (a Feistel network with cycle
   walking), so no block is taken more often than a pass more than another.
4. Blocks are joined to slots by (source, block index).

Layout without long windows: documents are dealt to ``SPREAD`` sub-streams of
their source by a hash, summed there, and offset by the sub-streams before, so a
source with a third of all rows is laid out by many tasks.  One row per source
and shard passes through the driver.

Defined results: a null source is a source of its own and comes last; null and
wordless texts have size 0 and are never taken; repeated rows are documents of
their own; an empty table gives no rows; sources without words have target 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardpanel.llm.tables import stored
from cardpanel.llm.tokens import mix

#: Words a block holds, output shards, sub-streams of a source, slots a plan row spans.
BLOCK_WORDS, SHARDS, SPREAD, SPAN = 64, 64, 1024, 1 << 16
#: Slots that a task permutes, about.
TASK_SLOTS = 1 << 18
WEIGHTS, MOST = (1, 2, 3), 3
U = np.uint64


def n_words(col: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(col), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """One row per source: source_no, source, source_size, target.

    Weights repeat over the sources by code point (null last).  A target is the
    weighted share of all words, at most ``most`` times the source; what the
    capped sources leave is shared again by weight.  Sorted by cap over weight,
    the capped sources come first, so one pass finds where sharing settles.
    The frame has one row per source and is ordered as a whole."""
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_cap = Window.orderBy(F.col("cap") / F.col("w"), "source_no")
    before, after = by_cap.rowsBetween(Window.unboundedPreceding, -1), by_cap.rowsBetween(0, Window.unboundedFollowing)
    out = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    out = out.withColumn("source_no", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    out = out.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), F.col("source_no") % len(weights) + 1))
    out = out.withColumn("cap", most * F.col("source_size"))
    out = out.withColumn("left", F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
    out = out.withColumn("open", F.sum("w").over(after))
    fits = F.col("cap").cast("double") * F.col("open") >= F.col("left").cast("double") * F.col("w")
    first = F.min(F.when(fits, F.struct(F.col("cap") / F.col("w"), "source_no", "left", "open"))).over(every)
    out = out.withColumn("f", first)
    capped = F.struct(F.col("cap") / F.col("w"), "source_no") < F.struct(F.col("f.col1"), F.col("f.source_no"))
    share = F.col("f.left").cast("double") * F.col("w") / F.col("f.open")
    return out.select("source_no", "source", "source_size",
                      F.when(capped | F.col("f").isNull(), F.col("cap").cast("double")).otherwise(share).alias("target"))


def quotas(size: np.ndarray, target: np.ndarray, block: int, most: int = MOST) -> tuple[np.ndarray, np.ndarray]:
    """(blocks, slots) of each source: whole passes, then as many blocks as the rest of the target holds."""
    blocks = -(-size // block)
    passes = np.minimum(most, np.floor(target / np.maximum(size, 1))).astype(np.int64)
    rest = np.rint((target - passes * size) / block).astype(np.int64)
    return blocks, passes * blocks + np.where(passes < most, np.clip(rest, 0, blocks), 0)


def draws(slots: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """Multinomial counts of each shard (rows) and source, ending on the quotas."""
    left, out = slots.astype(np.int64).copy(), np.zeros((shards, len(slots)), np.int64)
    for i in range(shards):
        rng, n = np.random.default_rng((seed, i)), int(left.sum()) // (shards - i)
        while n:  # what goes beyond a quota is drawn again among the others
            got = np.minimum(rng.multinomial(n, left / left.sum()), left)
            out[i] += got
            left -= got
            n -= int(got.sum())
    return out


def permuted(k: np.ndarray, n: int, key: int) -> np.ndarray:
    """Places of ``k`` (below ``n``) in the pseudorandom order named by ``key``."""
    half = U(max(1, -(-int(n - 1).bit_length() // 2)))
    low = (U(1) << half) - U(1)

    def once(x: np.ndarray) -> np.ndarray:
        a, b = x >> half, x & low
        for r in range(4):
            salt = U((key * 0x9E3779B97F4A7C15 + r * 0xC2B2AE3D27D4EB4F) & ((1 << 64) - 1))
            a, b = b, a ^ (mix(b + salt) & low)
        return (a << half) | b

    out = once(k.astype(U))
    while len(beyond := np.flatnonzero(out >= U(n))):
        out[beyond] = once(out[beyond])
    return out.astype(np.int64)


def slots(sources: DataFrame, block_words: int = BLOCK_WORDS, shards: int = SHARDS, seed: int = 7) -> DataFrame:
    """The mix: source_no, shard, slot (of the source, over all shards), block."""
    spark = sources.sparkSession
    rows = sources.orderBy("source_no").collect()  # one per source
    no = np.array([r.source_no for r in rows], np.int64)
    blocks, wanted = quotas(np.array([r.source_size for r in rows], np.int64), np.array([r.target for r in rows], float), block_words)
    counts = draws(wanted, shards, seed)
    first = np.cumsum(counts, axis=0) - counts
    plan = [(int(no[s]), int(i), int(first[i, s]), int(counts[i, s]), int(blocks[s])) for i, s in np.argwhere(counts)]
    plan = spark.createDataFrame(plan, "source_no int, shard int, first long, n long, blocks long")
    spans = plan.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(SPAN).cast("long"))).alias("at"))
    spans = spans.select("source_no", "shard", "blocks", (F.col("first") + F.col("at")).alias("first"),
                         F.least(F.lit(SPAN).cast("long"), F.col("n") - F.col("at")).alias("n"))

    def take(batches):
        for batch in batches:
            for r in batch.to_pylist():
                k = np.arange(r["first"], r["first"] + r["n"])
                block = np.empty(len(k), np.int64)
                for lap in np.unique(k // r["blocks"]):
                    on = k // r["blocks"] == lap
                    block[on] = permuted(k[on] % r["blocks"], r["blocks"], seed * 1_000_003 + r["source_no"] * 8 + int(lap))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), r["source_no"], np.int32)), pa.array(np.full(len(k), r["shard"], np.int32)),
                                                  pa.array(k), pa.array(block)], ["source_no", "shard", "slot", "block"])

    # a row stands for up to SPAN slots, which Spark can't see: the number of tasks is stated
    tasks = max(1, -(-int(counts.sum()) // TASK_SLOTS))
    wide = spans.repartition(tasks, F.col("source_no"), F.col("shard"), F.col("first"))
    return wide.mapInArrow(take, "source_no int, shard int, slot long, block long")


def laid_out(rows: DataFrame) -> DataFrame:
    """``rows`` (rid, doc_id, h, source_no, size) with ``pos``, the first word's place in the source."""
    rows = rows.withColumn("sub", F.pmod(F.xxhash64("doc_id", "h"), F.lit(SPREAD)))
    inside = Window.partitionBy("source_no", "sub").orderBy("doc_id", "h", "rid").rowsBetween(Window.unboundedPreceding, -1)
    subs = rows.groupBy("source_no", "sub").agg(F.sum("size").alias("_n"))
    earlier = Window.partitionBy("source_no").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
    subs = subs.select("source_no", "sub", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"))
    rows = rows.withColumn("_in", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(subs, ["source_no", "sub"])
    return rows.withColumn("pos", F.col("_off") + F.col("_in")).drop("_off", "_in", "sub")


def segments(placed: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The part of each block that each document fills: rid, source_no, block, skip, n."""
    b = F.lit(block_words)
    ends = F.col("pos") + F.col("size")
    part = placed.filter("size > 0").withColumn("block", F.explode(F.sequence(F.floor(F.col("pos") / b), F.floor((ends - 1) / b))))
    lo = F.greatest(F.col("pos"), F.col("block") * b)
    return part.select("rid", "source_no", "block", (lo - F.col("pos")).alias("skip"),
                       (F.least(ends, (F.col("block") + 1) * b) - lo).alias("n"))


def _rows(documents: DataFrame, text: bool = False) -> tuple[DataFrame, DataFrame]:
    """(documents with rid, size, source_no and pos; sources with targets), kept in the shared folder."""
    # rid only names the stored rows; the layout follows their content, so reruns agree
    kept = ["doc_id", "source", n_words().alias("size"), F.xxhash64("text").alias("h"), *(["text"] if text else []),
            F.monotonically_increasing_id().alias("rid")]
    rows = stored(documents.select(*kept), "mix-rows")
    sources = stored(targets(rows), "mix-sources")
    numbered = rows.join(sources.select("source_no", F.col("source").alias("_s")), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    return laid_out(numbered), sources


def mix_sources(documents: DataFrame, block_words: int = BLOCK_WORDS, shards: int = SHARDS, seed: int = 7) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken."""
    placed, sources = _rows(documents)
    placed = stored(placed, "mix-placed")
    times = slots(sources, block_words, shards, seed).groupBy("source_no", "block").agg(F.count("*").alias("times"))
    taken = segments(placed, block_words).join(times, ["source_no", "block"])
    taken = taken.groupBy("rid").agg(F.sum(F.col("n") * F.col("times")).alias("taken"))
    out = placed.join(taken, "rid", "left").join(sources.select("source_no", "source_size", "target"), "source_no")
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_blocks(documents: DataFrame, block_words: int = BLOCK_WORDS, shards: int = SHARDS, seed: int = 7) -> DataFrame:
    """The mixed corpus: shard, source, slot, block, text (the block's words)."""
    placed, sources = _rows(documents, text=True)
    parts = segments(placed, block_words).join(placed.select("rid", F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)).alias("_w")), "rid")
    parts = parts.select("source_no", "block", "rid", "skip", F.slice("_w", (F.col("skip") + 1).cast("int"), F.col("n").cast("int")).alias("_w"))
    place = placed.select("rid", "pos")
    parts = parts.join(place, "rid").groupBy("source_no", "block").agg(
        F.array_sort(F.collect_list(F.struct((F.col("pos") + F.col("skip")).alias("at"), "_w"))).alias("_p"))
    parts = parts.select("source_no", "block", F.array_join(F.flatten(F.transform("_p", lambda p: p["_w"])), " ").alias("text"))
    out = slots(sources, block_words, shards, seed).join(parts, ["source_no", "block"])
    return out.join(sources.select("source_no", "source"), "source_no").select("shard", "source", "slot", "block", "text")
