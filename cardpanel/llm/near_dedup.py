"""Near-duplicate documents: MinHash bands, sequential Bayesian verification, exact links.

1. ``sketches``: every whole text becomes the set of its word shingles, 252 minima
   of that set (16 bits each) and the 64-bit id of its class (documents with equal
   sets are one class, so copies are never compared).
2. Classes that agree in one of 42 bands of 6 minima are candidates; a pair at the
   threshold is missed with probability (1 - 0.8^6)^42 < 3e-6.
3. Each band bucket's members meet its leader (the class with most copies).  Pairs
   are compared minimum by minimum, 32 at a time; under a uniform prior the chance
   that the similarity reaches the threshold is P(Bin(n + 1, t) <= m) after m
   agreements in n, and a pair is dropped once it falls under ``MISS``.
4. Survivors are verified on their full shingle sets, and verified links are joined
   into components.
5. Only members of a bucket that are not yet connected can still add anything:
   those outside the bucket's largest component meet the rest of the bucket, block
   by block (about ``BLOCK`` x ``BLOCK`` members in a task): the same sequential test,
   then the full sets.  Only links leave the task, one for each member and component
   it reaches; no pair inside a connected group is ever formed.

Defined results: null, empty and wordless texts have an empty set, link with
nothing and are their own component; a document of fewer words than a shingle is
one shingle; ties go to the smallest doc_id; repeated rows are members of one
class; rows with null doc_id take part, the component's id is the smallest
non-null one (null where there is none); texts of any length are read whole; an empty
table gives no rows; other columns may have any name.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardpanel.llm.filters import bits_of, passes
from cardpanel.llm.graph import components
from cardpanel.llm.tables import apart, stored
from cardpanel.llm.tokens import LOWER, mix, windows, word_slices

ROWS, BANDS, STEP, MISS, BLOCK = 6, 42, 32, 1e-6, 256
#: Shingles of a block's members, about.
BLOCK_SHINGLES = 1 << 20
HASHES = ROWS * BANDS
U = np.uint64

_rng = np.random.default_rng(20240602)
_A = _rng.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)


def shingles(h: np.ndarray, k: int) -> np.ndarray:
    """The sorted set of word-shingle hashes of one text, given its word hashes."""
    if len(h) < k:
        return windows(h, len(h)) if len(h) else np.empty(0, U)
    return np.unique(windows(h, k))


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """The minima of each (non-empty) set under every hash, 16 bits kept."""
    out = np.empty((len(sets), HASHES), np.uint16)
    lo = 0
    while lo < len(sets):  # some ten thousand shingles at a time stay in the cache
        hi, size = lo, 0
        while hi < len(sets) and (hi == lo or size + len(sets[hi]) <= 1 << 15):
            size += len(sets[hi])
            hi += 1
        at = np.cumsum([0, *map(len, sets[lo : hi - 1])])
        x = (np.concatenate(sets[lo:hi]) >> U(32)).astype(np.uint32)
        tmp = np.empty_like(x)
        for i in range(HASHES):
            np.multiply(x, _A[i], out=tmp)
            np.add(tmp, _B[i], out=tmp)
            out[lo:hi, i] = (np.minimum.reduceat(tmp, at) * np.uint32(0x9E3779B1)) >> np.uint32(16)
        lo = hi
    return out


def class_id(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def bands(sig: np.ndarray) -> np.ndarray:
    """One 64-bit bucket per band of each signature."""
    x = sig.astype(U).reshape(len(sig), BANDS, ROWS)
    out = np.tile(np.arange(BANDS, dtype=U) * U(0x9E3779B97F4A7C15), (len(sig), 1))
    for i in range(ROWS):
        out = mix(out + x[:, :, i] + U(1))
    return out


def least_agreements(threshold: float, miss: float = MISS) -> list[int]:
    """Agreements that a pair needs after each step of comparison to stay."""
    need = []
    for n in [*range(STEP, HASHES, STEP), HASHES]:
        below, m = 0.0, -1
        while below < miss:
            m += 1
            below += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        need.append(m)
    return need


def alive(left: np.ndarray, right: np.ndarray, li: np.ndarray, ri: np.ndarray, need: list[int]) -> np.ndarray:
    """Which of the pairs (li, ri) of signature rows survive the sequential test."""
    pairs, agreed = np.arange(len(li)), np.zeros(len(li), np.int32)
    for step, least in enumerate(need):
        lo, hi = step * STEP, min((step + 1) * STEP, HASHES)
        agreed += (left[li[pairs], lo:hi] == right[ri[pairs], lo:hi]).sum(1)
        stay = agreed >= least
        pairs, agreed = pairs[stay], agreed[stay]
    return pairs


def sketches(documents: DataFrame, k: int) -> DataFrame:
    """doc_id, row (hash of id and text), n_shingles, cid, sig (empty sets: null cid and sig)."""

    def run(batches):
        for batch in batches:
            for lo, hi, w in word_slices(batch.column(2), fold=LOWER):
                sets = [shingles(w.hash[w.first[i] : w.first[i + 1]], k) for i in range(w.n)]
                full = [i for i, s in enumerate(sets) if len(s)]
                sig, cid = [None] * w.n, [None] * w.n
                for i, m in zip(full, minima([sets[i] for i in full]), strict=True):
                    sig[i], cid[i] = m.tobytes(), class_id(sets[i])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo),
                     pa.array([len(s) for s in sets], pa.int64()), pa.array(cid, pa.int64()), pa.array(sig, pa.binary())],
                    ["doc_id", "row", "n_shingles", "cid", "sig"])

    rows = documents.select(F.col("doc_id").cast("long"), F.xxhash64("doc_id", "text").alias("row"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, row long, n_shingles long, cid long, sig binary")


def _buckets(classes: DataFrame) -> DataFrame:
    """(bucket, cid, copies) of every band of every class."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                sig = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint16).reshape(-1, HASHES)
                each = [pa.array(np.repeat(batch.column(i).to_numpy(), BANDS)) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([pa.array(bands(sig).ravel().view(np.int64)), *each], ["bucket", "cid", "copies"])

    return classes.select("cid", "copies", "sig").mapInArrow(run, "bucket long, cid long, copies long")


def _likely(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """The distinct pairs (a, b) that the sequential test leaves."""
    need = least_agreements(threshold)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, HASHES) for i in (2, 3))
                each = np.arange(batch.num_rows)
                yield batch.select([0, 1]).take(pa.array(alive(a, b, each, each, need)))

    sig = classes.select("cid", "sig", "n_shingles")
    met = pairs.join(sig.toDF("a", "sa", "na"), "a").join(sig.toDF("b", "sb", "nb"), "b")
    met = met.filter(F.least("na", "nb") >= threshold * F.greatest("na", "nb") - 1e-6)
    return met.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def _sets(documents: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """(cid, shingles) of the texts whose row hash is in ``rows`` (and of few others)."""
    shared = documents.sparkSession.sparkContext.broadcast(bits_of(rows, "row"))

    def run(batches):
        wanted = shared.value
        for batch in batches:
            batch = batch.filter(pa.array(passes(wanted, batch.column(0).to_numpy())))
            for _, _, w in word_slices(batch.column(1), fold=LOWER):
                sets = [s for i in range(w.n) if len(s := shingles(w.hash[w.first[i] : w.first[i + 1]], k))]
                if sets:
                    ends = np.cumsum([0, *map(len, sets)])
                    values = pa.array(np.concatenate(sets).view(np.int64))
                    yield pa.RecordBatch.from_arrays([pa.array([class_id(s) for s in sets], pa.int64()),
                                                      pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)], ["cid", "shingles"])

    texts = documents.select(F.xxhash64("doc_id", "text").alias("row"), F.col("text").cast("string"))
    return texts.mapInArrow(run, "cid long, shingles array<long>")


def _verified(likely: DataFrame, classes: DataFrame, documents: DataFrame, k: int, threshold: float) -> DataFrame:
    """The pairs whose full shingle sets reach the threshold."""
    nodes = likely.select(F.col("a").alias("cid")).union(likely.select("b")).distinct()
    chosen = classes.join(nodes, "cid").select("cid", "row")
    sets = _sets(documents, chosen, k).join(chosen.select("cid"), "cid").dropDuplicates(["cid"])
    sets = stored(sets, "sets")
    met = likely.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")
    met = met.withColumn("both", F.size(F.array_intersect("sa", "sb")))
    percent = round(100 * threshold)
    return stored(met.filter(100 * F.col("both") >= percent * (F.size("sa") + F.size("sb") - F.col("both"))).select("a", "b"), "links")


def _unresolved(buckets: DataFrame, leaders: DataFrame, roots: DataFrame, classes: DataFrame, documents: DataFrame, k: int, threshold: float) -> DataFrame:
    """Links within buckets that the leaders' links have not connected."""
    members = buckets.join(leaders.filter("n > 2").select("bucket", "leader"), "bucket").filter("cid != leader")
    members = members.join(roots.withColumnRenamed("node", "cid"), "cid", "left").join(classes.select("cid", "n_shingles"), "cid")
    members = members.select("bucket", "cid", "n_shingles", F.coalesce("root", "cid").alias("comp"))
    groups = members.groupBy("bucket", "comp").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("s"))
    groups = groups.groupBy("bucket").agg(F.max(F.struct("n", "comp", "s")).alias("top"), F.sum("n").alias("n"), F.sum("s").alias("s")).filter("n > top.n")
    blocks = lambda n, s: F.ceil(F.greatest(n / BLOCK, s / BLOCK_SHINGLES))
    groups = groups.select("bucket", F.col("top.comp").alias("main"), blocks(F.col("n"), F.col("s")).alias("nj"),
                           blocks(F.col("n") - F.col("top.n"), F.col("s") - F.col("top.s")).alias("ni"))
    members = stored(members.join(groups, "bucket").withColumn("is_out", F.col("comp") != F.col("main")), "unresolved")
    deal = lambda n, seed: F.pmod(F.xxhash64("cid", F.lit(seed)), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    left = members.filter("is_out").withColumn("i", deal("ni", 1)).withColumn("j", every("nj"))
    right = members.withColumn("j", deal("nj", 2)).withColumn("i", every("ni"))
    shared = [F.col(c) for c in ("bucket", "i", "j", "cid", "comp", "n_shingles", "is_out")]
    both = left.select(*shared, F.lit(True).alias("asks")).union(right.select(*shared, F.lit(False)))
    chosen = members.select("cid").distinct().join(classes.select("cid", "row", "sig"), "cid")
    chosen = stored(chosen, "unresolved-classes")
    sets = _sets(documents, chosen, k).join(chosen.select("cid", "sig"), "cid").dropDuplicates(["cid"])
    both = both.join(sets, "cid")
    need, percent = least_agreements(threshold), round(100 * threshold)

    def compare(block: pd.DataFrame) -> pd.DataFrame:
        l, r = block[block["asks"]], block[~block["asks"]]
        lc, rc, ln, rn = l["cid"].to_numpy(), r["cid"].to_numpy(), l["n_shingles"].to_numpy(), r["n_shingles"].to_numpy()
        comp = r["comp"].to_numpy()
        apart = l["comp"].to_numpy()[:, None] != comp[None, :]
        apart &= ~r["is_out"].to_numpy()[None, :] | (lc[:, None] < rc[None, :])
        apart &= np.minimum(ln[:, None], rn[None, :]) >= threshold * np.maximum(ln[:, None], rn[None, :]) - 1e-6
        li, ri = np.nonzero(apart)
        found = []
        if len(li):
            sig = [np.frombuffer(b"".join(x["sig"]), np.uint16).reshape(-1, HASHES) for x in (l, r)]
            stay = alive(*sig, li, ri, need)
            li, ri = li[stay], ri[stay]
            names, at = np.unique(np.concatenate([np.empty(0, np.int64), *r["shingles"]]), return_inverse=True)
            edges = np.concatenate([[0], np.cumsum(rn)[:-1]])
            for i in np.unique(li):
                mine, own = np.zeros(len(names), np.int32), l["shingles"].iloc[i]
                to = np.minimum(np.searchsorted(names, own), len(names) - 1)
                mine[to[names[to] == own]] = 1
                common = np.add.reduceat(mine[at], edges)
                on = ri[li == i]
                on = on[100 * common[on] >= percent * (ln[i] + rn[on] - common[on])]
                found += [(lc[i], rc[on[x]]) for x in np.unique(comp[on], return_index=True)[1]]
        a, b = np.array(found, np.int64).reshape(-1, 2).T
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return stored(both.groupBy("bucket", "i", "j").applyInPandas(compare, "a long, b long").distinct(), "links-rest")


def near_duplicates(documents: DataFrame, k: int = 5, threshold: float = 0.8) -> DataFrame:
    """One row per document: doc_id, row, n_shingles, component_id, kept, first_row
    (``row`` of the component's first document: smallest id, then smallest row)."""
    nodes = stored(sketches(documents, k), "sketches")
    full = nodes.filter("cid is not null")
    classes = stored(full.groupBy("cid").agg(
        F.min("doc_id").alias("first_id"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("head"), F.count("*").alias("copies"),
        F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig")).select(
        "cid", "first_id", "head", F.col("head.row").alias("row"), "copies", "n_shingles", "sig"), "classes")
    buckets = _buckets(classes)
    leaders = buckets.groupBy("bucket").agg(F.max(F.struct("copies", "cid"))["cid"].alias("leader"), F.count("*").alias("n")).filter("n > 1")
    leaders = stored(leaders, "leaders")
    buckets = stored(buckets.select("bucket", "cid").join(leaders.select("bucket"), "bucket"), "buckets")
    met = buckets.join(leaders, "bucket").filter("cid != leader")
    pairs = met.select(F.least("cid", "leader").alias("a"), F.greatest("cid", "leader").alias("b")).distinct()
    likely = stored(_likely(pairs, classes, threshold), "likely")
    links = _verified(likely, classes, documents, k, threshold)
    links = links.union(_unresolved(buckets, leaders, components(links), classes, documents, k, threshold))
    named = classes.select("cid", "first_id", "head").join(components(links).withColumnRenamed("node", "cid"), "cid", "left")
    named = named.withColumn("root", F.coalesce("root", "cid"))
    heads = named.groupBy("root").agg(F.min("first_id").alias("component_id"), F.min("head").alias("head"))
    named = named.select("cid", "root").join(heads, "root").select("cid", "component_id", F.col("head.row").alias("first_row"))
    out = full.join(named, "cid").select("doc_id", "row", "n_shingles", "component_id", "first_row")
    alone = nodes.filter("cid is null").select("doc_id", "row", "n_shingles", F.col("doc_id").alias("component_id"), F.col("row").alias("first_row"))
    return out.union(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(documents: DataFrame, k: int = 5, threshold: float = 0.8) -> DataFrame:
    """``documents`` with one row of each group of near duplicates (documents
    without words all stay, but for repeated rows), all columns kept.  Of rows with
    equal id and text any one stays."""
    found = near_duplicates(documents, k, threshold)
    first = found.filter("row = first_row").select(F.col("row").alias("_row")).distinct()

    def kept(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_row", F.xxhash64("doc_id", "text")).join(first, "_row", "left_semi").dropDuplicates(["_row"])

    return apart(documents, kept)
