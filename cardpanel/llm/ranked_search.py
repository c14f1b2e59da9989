"""Ranked lexical search over posting lists cut into geometric blocks.

A batch of items (queries) is answered over all documents:

1. ``vectors``: every whole text becomes its length and the counts of the batch's terms
   (other terms add to no score); document numbers and frequencies follow from that.
2. ``index``: each task takes some hundred documents at a time (a shard).  The posting
   list of every term is clustered by document similarity: inner products of 32-dimensional
   sketches with some members of the list.  Each cluster is a block, and its summary holds
   for every term that shares an item with the list's term the maximum of that coordinate
   over the block's documents.  Shards are stored, one row each: documents with their exact
   impacts, lists, blocks, summaries.
3. ``search``: an item visits its lists in a shard by falling maximum.  A block is skipped
   only if the sum of its summary over the item's terms is below the score that the k-th
   best document is known to have; the others' documents are scored exactly, once each.
   The visit ends when all lists left together can't reach that score.  A first search over
   an eighth of the shards gives the score to begin with; it is a lower bound, so the result
   is exact.
4. The best ``k`` of each shard are merged in two steps.

A summary has at most ``WIDTH`` coordinates; for a further one the list's own maximum
stands in, which is a bound, too.  Summaries are rounded up to 32 bits.

Defined results: null, empty and termless texts have no terms and are no documents to the
statistics; items without terms, and items that no document scores for, give no rows; equal
scores go by ascending doc_id, nulls last; repeated rows are documents (or items) of their
own; texts of any length are read whole; other columns are never read.  Terms travel as
64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardpanel.llm.tables import stored
from cardpanel.llm.tokens import LOWER, NON_ALNUM, word_slices

TOP = 50
#: Terms of the items of a batch, about; documents of a shard at most, and cells of its matrix.
TERMS, SHARD, CELLS = 16384, 2048, 1 << 23
#: Postings of a block, about; coordinates of a summary; share of the shards that is searched first.
BLOCK, WIDTH, FIRST = 256, 2048, 8
SKETCH = 32


class Batch(NamedTuple):
    """Items that are searched together."""

    ids: list[int | None]
    items: list[np.ndarray]  # terms of each, as places in ``terms``
    terms: np.ndarray  # sorted hashes
    near: list[np.ndarray]  # for each term the sorted terms of its summaries


class Statistics(NamedTuple):
    documents: int
    length: int
    weight: np.ndarray


def _items(items: DataFrame) -> DataFrame:
    """(item_id, terms) with the distinct term hashes of each item that has any."""

    def run(batches):
        for batch in batches:
            for lo, hi, w in word_slices(batch.column(1), NON_ALNUM, LOWER):
                terms = [np.unique(w.hash[w.first[i] : w.first[i + 1]].view(np.int64)) for i in range(w.n)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(terms, pa.list_(pa.int64()))], ["item_id", "terms"])

    rows = items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "item_id long, terms array<long>")
    return stored(rows.filter(F.size("terms") > 0).withColumn("item", F.monotonically_increasing_id()), "search-items")


def _batches(items: DataFrame) -> Iterator[Batch]:
    found = _items(items)
    total = found.agg(F.sum(F.size("terms"))).first()[0] or 0
    n = -(-total // TERMS)
    for i in range(n):
        rows = found.filter(F.pmod(F.xxhash64("item"), F.lit(n)) == i).orderBy("item").toArrow()
        if rows.num_rows:
            hashes = [np.array(t) for t in rows["terms"].to_pylist()]
            terms = np.unique(np.concatenate(hashes))
            places = [np.searchsorted(terms, h).astype(np.int32) for h in hashes]
            yield Batch(rows["item_id"].to_pylist(), places, terms, _near(places, len(terms)))


def _near(items: list[np.ndarray], n: int) -> list[np.ndarray]:
    holds: list[list[int]] = [[] for _ in range(n)]
    for i, terms in enumerate(items):
        for t in terms:
            holds[t].append(i)
    out = []
    for t, at in enumerate(holds):
        near, count = np.unique(np.concatenate([items[i] for i in at]), return_counts=True)
        if len(near) > WIDTH:
            near = np.sort(near[np.lexsort((near, near != t, -count))[:WIDTH]])  # those it shares most items with, itself among them
        out.append(near.astype(np.int32))
    return out


def _vectors(documents: DataFrame, batch: Broadcast) -> DataFrame:
    """(doc_id, n, terms, tf) of every document with a term; ``terms`` are the batch's."""

    def run(batches):
        known = batch.value.terms
        for rows in batches:
            for lo, hi, w in word_slices(rows.column(1), NON_ALNUM, LOWER):
                h = w.hash.view(np.int64)
                at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                met = known[at] == h
                pair, tf = np.unique(w.doc()[met] * len(known) + at[met], return_counts=True)
                ends = np.searchsorted(pair, np.arange(w.n + 1) * len(known)).astype(np.int32)
                terms = pa.array((pair % len(known)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).slice(lo, hi - lo), pa.array(w.counts()), pa.ListArray.from_arrays(pa.array(ends), terms),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(tf.astype(np.int32)))], ["doc_id", "n", "terms", "tf"])

    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = rows.mapInArrow(run, "doc_id long, n long, terms array<int>, tf array<int>").filter("n > 0")
    return stored(rows, "search-vectors")


def _statistics(vectors: DataFrame, n_terms: int) -> Statistics:
    def run(batches):
        df = np.zeros(n_terms, np.int64)
        for rows in batches:
            df += np.bincount(rows.column(0).flatten().to_numpy(), minlength=n_terms)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(df[at])], ["term", "df"])

    total = vectors.agg(F.count("*").alias("n"), F.sum("n").alias("length")).first()
    counts = vectors.select("terms").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    df = np.zeros(n_terms, np.int64)
    df[counts["term"].to_numpy()] = counts["df"].to_numpy()
    weight = np.floor(1000 * np.log((2 * total["n"] + 2) / (2 * df + 1))).astype(np.int64)
    return Statistics(total["n"], total["length"] or 0, weight)


def impacts(n: np.ndarray, tf: np.ndarray, term: np.ndarray, s: Statistics) -> np.ndarray:
    """What each posting (of a document of ``n`` terms) adds to the score of an item."""
    m = 100 - 50 + (50 * n * s.documents) // s.length
    return s.weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


def clustered(sketch: np.ndarray, size: int) -> np.ndarray:
    """Block of each of a list's documents: the most similar of some of them."""
    n = -(-len(sketch) // size)
    if n < 2:
        return np.zeros(len(sketch), np.int64)
    return (sketch @ sketch[np.linspace(0, len(sketch) - 1, n).astype(int)].T).argmax(1)


class Shard(NamedTuple):
    """Some documents and their blocked posting lists (of the terms that occur)."""

    doc_id: pa.Array
    ends: np.ndarray  # postings of document i are ends[i]:ends[i + 1]
    term: np.ndarray
    impact: np.ndarray
    lists: np.ndarray  # terms with a list
    first: np.ndarray  # blocks of list j are first[j]:first[j + 1]
    block: np.ndarray  # documents of block b are docs[block[b]:block[b + 1]]
    docs: np.ndarray
    summary: np.ndarray  # list after list: blocks x near terms that occur here, 32-bit

    #: Types of all but the ids.
    TYPES = (np.int32, np.int32, np.int64, np.int32, np.int32, np.int32, np.int32, np.float32)


def up(x: np.ndarray) -> np.ndarray:
    """To 32 bits, never less."""
    y = x.astype(np.float32)
    return np.where(y.astype(float) < x, np.nextafter(y, np.float32(np.inf)), y)


def build(doc_id: pa.Array, n: np.ndarray, ends: np.ndarray, term: np.ndarray, tf: np.ndarray, s: Statistics, near: list[np.ndarray]) -> Shard:
    rows = np.repeat(np.arange(len(n)), np.diff(ends))
    impact = impacts(n[rows], tf.astype(np.int64), term, s)
    kept = impact > 0
    rows, term, impact = rows[kept], term[kept], impact[kept]
    ends = np.searchsorted(rows, np.arange(len(n) + 1))
    used = np.unique(term)
    table = np.zeros((len(used), len(n)))  # impacts are whole numbers below 2^53
    table[np.searchsorted(used, term), rows] = impact
    sketch = table.T @ np.random.default_rng(20240613).standard_normal((len(s.weight), SKETCH))[used]
    sketch /= np.maximum(np.linalg.norm(sketch, axis=1, keepdims=True), 1e-300)
    place = np.full(len(s.weight), -1, np.int32)
    place[used] = np.arange(len(used))
    first, block, docs, summary = [0], [0], [], []
    for t in used:
        d = np.flatnonzero(table[place[t]])
        of = clustered(sketch[d], BLOCK)
        d = d[np.argsort(of, kind="stable")]
        size = np.bincount(of)
        size = size[size > 0]
        begin = np.cumsum(size) - size
        at = place[near[t]]
        summary.append(up(np.maximum.reduceat(table[np.ix_(at[at >= 0], d)], begin, axis=1).T).ravel())
        block.extend(block[-1] + size.cumsum())
        first.append(len(block) - 1)
        docs.append(d.astype(np.int32))
    flat = lambda x, kind: np.concatenate(x) if x else np.empty(0, kind)
    return Shard(doc_id, ends, term, impact, used, np.array(first), np.array(block), flat(docs, np.int32), flat(summary, np.float32))


#: A writer's buffer is looked at after every row and written at some MB, not after a hundred rows of some MB each.
FEW_LARGE_ROWS = {"parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1", "parquet.block.size": str(8 << 20), "parquet.enable.dictionary": "false"}
SHARD_SCHEMA = "shard long, doc_id array<long>, " + ", ".join(f"{c} binary" for c in Shard._fields[1:])


def _blob(x: np.ndarray, kind: type) -> pa.Array:
    """An array of one value, the bytes of ``x``, which are not copied."""
    x = np.ascontiguousarray(x, kind)
    return pa.Array.from_buffers(pa.binary(), 1, [None, pa.py_buffer(np.array([0, x.nbytes], np.int32)), pa.py_buffer(x)])


def _index(vectors: DataFrame, s: Statistics, batch: Broadcast) -> DataFrame:
    """One row per shard."""
    size = max(64, min(SHARD, CELLS // max(len(s.weight), 1)))

    def run(batches):
        near = batch.value.near
        for rows in batches:
            for lo in range(0, rows.num_rows, size):
                part = rows.slice(lo, size)
                term, tf = (part.column(i).flatten().to_numpy() for i in (2, 3))
                ends = np.concatenate([[0], np.cumsum(np.asarray(part.column(2).value_lengths()))])
                ids = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), pa.concat_arrays([part.column(0)]))
                blobs = [_blob(x, t) for x, t in zip(build(part.column(0), part.column(1).to_numpy(), ends, term, tf, s, near)[1:], Shard.TYPES, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([0], pa.int64()), ids, *blobs], ["shard", "doc_id", *Shard._fields[1:]])
                del blobs

    rows = vectors.filter(F.size("terms") > 0).select("doc_id", "n", "terms", "tf")
    made = rows.mapInArrow(run, SHARD_SCHEMA).withColumn("shard", F.xxhash64("doc_id"))
    return stored(made, "search-index", options=FEW_LARGE_ROWS)


def best(score: np.ndarray, doc_id: pa.Array, at: np.ndarray, k: int) -> np.ndarray:
    """The k places of highest score, ties by ascending id (nulls last)."""
    ids = doc_id.take(pa.array(at))
    number = ids.fill_null(0).to_numpy()
    return np.lexsort((number, np.asarray(ids.is_null()), -score))[:k]


def visit(x: Shard, lists: "Lists", item: np.ndarray, least: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) that may be among the k best of the item: all that score ``least`` or more, or the shard's k best of them."""
    mine = item[lists.at[item] >= 0]
    j = lists.at[mine]
    mine, j = mine[order := np.argsort(-lists.top[j], kind="stable")], j[order]
    left, wanted = float(lists.top[j].sum()), lists.wanted
    docs, scores = np.empty(0, np.int64), np.empty(0, np.int64)
    if left < least:
        return docs, scores
    wanted[mine] = True
    seen = np.zeros(len(x.ends) - 1, bool)
    for t, i in zip(mine.tolist(), j.tolist()):
        if left < least:
            break
        left -= lists.top[i]
        summary, at = lists.summary(i), np.searchsorted(lists.near[t], mine)
        there = lists.near[t][np.minimum(at, len(lists.near[t]) - 1)] == mine
        bound = summary[:, at[there]].sum(1, dtype=float) + lists.top[j[~there]].sum()
        for b in np.flatnonzero(bound >= least) + x.first[i]:
            new = x.docs[x.block[b] : x.block[b + 1]]
            new = new[~seen[new]]
            seen[new] = True
            if not len(new):
                continue
            score = lists.scores(new)
            good = score >= least
            docs, scores = np.concatenate([docs, new[good]]), np.concatenate([scores, score[good]])
            if len(docs) > 4 * k:
                keep = best(scores, x.doc_id, docs, k)
                docs, scores = docs[keep], scores[keep]
                least = max(least, int(scores[-1]))
    wanted[mine] = False
    keep = best(scores, x.doc_id, docs, k)
    return docs[keep], scores[keep]


class Lists:
    """Access to the lists of a shard."""

    def __init__(self, x: Shard, near: list[np.ndarray]):
        held = np.zeros(len(near), bool)
        held[x.lists] = True
        #: The near terms of each list that occur here.
        self.x, self.near = x, {t: near[t][held[near[t]]] for t in x.lists.tolist()}
        self.at = np.full(len(near), -1)
        self.at[x.lists] = np.arange(len(x.lists))
        width = np.array([len(n) for n in self.near.values()], np.int64)
        self.begin = np.concatenate([[0], np.cumsum(np.diff(x.first) * width)]).astype(np.int64)
        self.wanted = np.zeros(len(near), bool)
        #: The greatest impact of each list.
        own = [np.searchsorted(n, t) for t, n in self.near.items()]
        self.top = np.array([float(self.summary(i)[:, c].max()) for i, c in enumerate(own)])

    def summary(self, i: int) -> np.ndarray:
        return self.x.summary[self.begin[i] : self.begin[i + 1]].reshape(self.x.first[i + 1] - self.x.first[i], -1)

    def scores(self, docs: np.ndarray) -> np.ndarray:
        """Exact scores (every document here has a posting)."""
        lo, n = self.x.ends[docs], self.x.ends[docs + 1] - self.x.ends[docs]
        begin = np.cumsum(n) - n
        at = np.arange(n.sum()) + np.repeat(lo - begin, n)
        return np.add.reduceat(self.x.impact[at] * self.wanted[self.x.term[at]], begin)


def _search(index: DataFrame, batch: Broadcast, least: list[int], k: int) -> DataFrame:
    """(item, shard, doc_id, score) of the documents that may be among the k best."""

    def run(batches):
        items, near = batch.value.items, batch.value.near
        for rows in batches:
            for r in range(rows.num_rows):
                ids = rows.column(1)[r].values
                x = Shard(ids, *(np.frombuffer(rows.column(c + 2)[r].as_buffer(), t) for c, t in enumerate(Shard.TYPES)))
                if not len(x.lists):
                    continue
                lists, item, docs, scores = Lists(x, near), [], [], []
                for i, terms in enumerate(items):
                    d, s = visit(x, lists, terms, max(least[i], 1), k)
                    item.append(np.full(len(d), i, np.int32))
                    docs.append(d)
                    scores.append(s)
                item = np.concatenate(item)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(item), pa.array(np.full(len(item), rows.column(0)[r].as_py(), np.int64)), ids.take(pa.array(np.concatenate(docs))),
                     pa.array(np.concatenate(scores))], ["item", "shard", "doc_id", "score"])

    return index.mapInArrow(run, "item int, shard long, doc_id long, score long")


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The k best of each item with their rank; shards are merged in groups first."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    for keys in (["item", "group"], ["item"]):
        found = found.withColumn("group", F.pmod("shard", F.lit(64))) if "group" in keys else found
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= k)
    return found


def ranked(documents: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of every item."""
    spark = documents.sparkSession
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for batch in _batches(items):
        shared = spark.sparkContext.broadcast(batch)
        vectors = _vectors(documents, shared)
        s = _statistics(vectors, len(batch.terms))
        if not s.length:
            break
        index = _index(vectors, s, shared)
        n = len(batch.items)
        first = _merged(_search(index.filter(F.pmod("shard", F.lit(FIRST)) == 0), shared, [0] * n, k), k).filter(F.col("rank") == k)
        least = [0] * n
        for r in first.select("item", "score").collect():
            least[r["item"]] = r["score"]
        found = stored(_merged(_search(index, shared, least, k), k).select("item", "rank", "doc_id", "score"), "search-ranks")
        names = spark.createDataFrame(list(enumerate(batch.ids)), "item int, item_id long")
        out = out.union(found.join(names, "item").select("item_id", "rank", "doc_id", "score"))
    return out
