"""Information-theoretic sanitisation of personal data.

Protected entities are the personal values that patterns find in whole texts
(email, ip, card, phone; one entity per normalised value).  The context of a
mention is the ``CONTEXT`` words on either side.  Over all documents, with N words,
n(e) word positions in contexts of e, c(t) occurrences of term t and c(t, e) of
them in contexts of e, the information that t gives about e is
PMI = log p(e|t) / p(e) with p(e) = n(e) / N and p(e|t) = c(t, e) / c(t), and the
disclosure is the part of e's own information that it makes up: PMI / -log p(e),
1 if t occurs only with e.  A term in e's context is generalised to its class
from ``GENERALISE`` on and removed from ``REMOVE`` on; the entity itself is
replaced by its kind.  Documents without personal values are left alone.

Terms are lower-cased runs of letters and digits, counted by 64-bit hashes; only
terms of contexts are counted, which a filter of fixed size sees to.

Defined results: null reads as empty; texts without values have no spans; a term
in contexts of several entities counts by the highest disclosure; values may
overlap between kinds, and replacing skips what begins inside the span before;
repeated rows count as often as they occur and keep their rows; empty tables give
no rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardpanel.llm.filters import bits_of, passes
from cardpanel.llm.tables import apart, stored
from cardpanel.llm.tokens import LOWER, NON_ALNUM, buffers, word_slices, words

CONTEXT, GENERALISE, REMOVE = 8, 0.85, 0.95
# Kinds of spans, in their order.
KINDS = ["email", "ip", "card", "phone", "generalised", "removed"]

# The patterns work on UTF-8 bytes (all classes are ASCII) and never look at a byte
# more than a few times: where a match must begin at the head of a run, the run is
# taken whole.
_DOMAIN = re.compile(rb"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(rb"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(rb"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(rb"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_NOT_DIGITS = bytes(i for i in range(256) if not 0x30 <= i <= 0x39)


def luhn(digits: bytes) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d -= 0x30
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def values(text: bytes) -> list[tuple[int, int, int, bytes]]:
    """(start, end, kind number, normalised value) by byte offsets, by start, kind and end."""
    out, end = [], 0
    for m in _DOMAIN.finditer(text):
        at = m.start()
        while at > end and text[at - 1] in _LOCAL:
            at -= 1
        if at < m.start():
            end = m.end()
            out.append((at, end, 0, text[at:end].lower()))
    for m in _IP.finditer(text):
        parts = [p.lstrip(b"0") for p in m.group().split(b".")]
        if all(len(p) < 3 or len(p) == 3 and p <= b"255" for p in parts):
            out.append((*m.span(), 1, b".".join(p or b"0" for p in parts)))
    for pattern, kind, least, most in ((_CARD, 2, 14, 19), (_PHONE, 3, 10, 15)):
        for m in pattern.finditer(text):
            digits = m.group().translate(None, _NOT_DIGITS)
            if least <= len(digits) <= most and (kind == 3 or luhn(digits)):
                out.append((*m.span(), kind, digits))
    return sorted(out, key=lambda x: (x[0], x[2], x[1]))


def contexts(text: np.ndarray, found: list[tuple[int, int, int, bytes]], size: int = CONTEXT) -> tuple[list, ...]:
    """(entity, term, start, end) of the words round each value, by byte offsets;
    words that touch a value are none, and a word counts once per entity."""
    w = words(text, np.array([0, len(text)]), NON_ALNUM, LOWER)
    edges = np.zeros(len(text) + 1, np.int32)
    for s, e, *_ in found:
        edges[s] += 1
        edges[e] -= 1
    inside = np.concatenate([[0], np.cumsum(np.cumsum(edges[:-1]) > 0)])
    free = inside[w.end] == inside[w.start]
    seen: dict[tuple[int, int], None] = {}
    for s, e, kind, value in found:
        entity = xxhash.xxh64_intdigest(b"%d:" % kind + value)
        before, after = int(np.searchsorted(w.end, s, "right")), int(np.searchsorted(w.start, e))
        for i in [*range(max(0, before - size), before), *range(after, min(len(w.start), after + size))]:
            if free[i]:
                seen[entity, i] = None
    at = [i for _, i in seen]
    return [e for e, _ in seen], w.hash[at], w.start[at], w.end[at]


_NEAR = "array<struct<e:bigint,t:bigint,start:int,end:int>>"
_FOUND = f"row bigint, kinds array<int>, starts array<int>, ends array<int>, near {_NEAR}"


def found(documents: DataFrame) -> DataFrame:
    """doc_id, row (hash of id and text), base spans by code points and context words of each document."""

    def run(batches):
        for batch in batches:
            data, offsets = buffers(batch.column(2))
            spans, near, sizes = [], [], []
            for i in range(batch.num_rows):
                text = data[offsets[i] : offsets[i + 1]]
                got = values(text.tobytes())
                spans.append(got)
                sizes.append(0)
                if got:
                    chars = np.concatenate([[0], np.cumsum((text & 0xC0) != 0x80)])
                    e, t, s, n = contexts(text, got)
                    near.append((np.array(e, np.uint64), t, chars[s], chars[n]))
                    sizes[-1] = len(e)
                    spans[-1] = [(chars[a], chars[b], k) for a, b, k, _ in got]
            flat = [np.concatenate([x[k] for x in near]) if near else np.empty(0, np.uint64) for k in range(4)]
            items = pa.StructArray.from_arrays(
                [pa.array(flat[0].view(np.int64)), pa.array(flat[1].view(np.int64)), pa.array(flat[2].astype(np.int32)), pa.array(flat[3].astype(np.int32))],
                ["e", "t", "start", "end"])
            ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            lists = [pa.array([[int(x[k]) for x in s] for s in spans], pa.list_(pa.int32())) for k in (2, 0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *lists, pa.ListArray.from_arrays(ends, items)],
                                             ["doc_id", "row", "kinds", "starts", "ends", "near"])

    rows = documents.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), F.col("text").cast("string"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, {_FOUND}")


def term_counts(documents: DataFrame, terms: DataFrame) -> DataFrame:
    """(t, c) over all documents, for the terms in ``terms`` and a few others; the
    row with null t has the number of all words."""
    shared = documents.sparkSession.sparkContext.broadcast(bits_of(terms, "t"))

    def run(batches):
        wanted = shared.value
        for batch in batches:
            for _, _, w in word_slices(batch.column(0), NON_ALNUM, LOWER):
                t, c = np.unique(w.hash[passes(wanted, w.hash)], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([None, *t.view(np.int64)], pa.int64()), pa.array([len(w.hash), *c], pa.int64())], ["t", "c"])

    return documents.select(F.col("text").cast("string")).mapInArrow(run, "t long, c long").groupBy("t").agg(F.sum("c").alias("c"))


def disclosures(near: DataFrame, counts: DataFrame) -> DataFrame:
    """(e, t, disclosure) of every entity and context term."""
    total = counts.filter("t is null").agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n")).first()["n"]
    pairs = near.groupBy("e", "t").agg(F.count("*").alias("c_te"))
    own = pairs.groupBy("e").agg(F.sum("c_te").alias("n_e"))
    rows = pairs.join(own, "e").join(counts, "t")
    information = -F.log(F.col("n_e") / F.lit(float(max(total, 1))))
    pmi = F.log(F.col("c_te") / F.col("c")) + information
    return rows.select("e", "t", F.when(information > 0, pmi / information).otherwise(F.lit(0.0)).alias("disclosure"))


def spans(documents: DataFrame, generalise: float = GENERALISE, remove: float = REMOVE) -> tuple[DataFrame, DataFrame]:
    """(found documents, (row, spans) of those with values); a span is (start, kind, end)."""
    base = stored(found(documents), "values")
    near = base.select("row", F.explode("near").alias("x")).select("row", "x.*")
    counts = stored(term_counts(documents, near.select("t").distinct()), "terms")
    telling = stored(disclosures(near, counts).filter(F.col("disclosure") >= generalise), "telling")
    hits = near.join(telling, ["e", "t"]).groupBy("row", "start", "end").agg(F.max("disclosure").alias("d"))
    kind = F.when(F.col("d") >= remove, KINDS.index("removed")).otherwise(KINDS.index("generalised"))
    hits = hits.select("row", F.struct("start", kind.alias("kind"), "end").alias("x"))
    own = base.filter(F.size("kinds") > 0).select("row", F.explode(F.arrays_zip("starts", "kinds", "ends")).alias("x")).select(
        "row", F.struct(F.col("x.starts").alias("start"), F.col("x.kinds").alias("kind"), F.col("x.ends").alias("end")).alias("x"))
    return base, own.union(hits).groupBy("row").agg(F.array_sort(F.collect_set("x")).alias("spans"))


def written(items: Column) -> Column:
    """kind:start:end of spans, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(items, one), ",")


def _is(kind: int):
    return lambda k: k == kind


def detected(documents: DataFrame, generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    base, all_spans = spans(documents, generalise, remove)
    out = base.join(all_spans, "row", "left")
    zipped = F.transform(F.arrays_zip("starts", "kinds", "ends"), lambda x: F.struct(x["starts"].alias("start"), x["kinds"].alias("kind"), x["ends"].alias("end")))
    n = [F.size(F.array_remove(F.transform("kinds", _is(i)), False)).cast("long").alias(f"n_{KINDS[i]}") for i in range(4)]
    return out.select("doc_id", *n, F.sha2(written(zipped), 256).alias("base_sha256"), F.coalesce(written(F.col("spans")), F.lit("")).alias("spans"))


def replaced(text: str, items: list[tuple[int, int, int]]) -> str:
    """``text`` with its spans (start, kind, end) replaced by kinds and classes."""
    out, at = [], 0
    for start, kind, end in items:
        if start < at:
            continue
        word = text[start:end]
        new = "" if KINDS[kind] == "removed" else f"[{KINDS[kind].upper()}]" if kind < 4 else "[NUMBER]" if word.isdigit() else "[TERM]"
        out += [text[at:start], new]
        at = end
    return "".join([*out, text[at:]])


def sanitised(documents: DataFrame, generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """``documents`` with the spans of ``text`` replaced, all columns kept.  Only
    documents that may have spans are shuffled."""
    _, all_spans = spans(documents, generalise, remove)
    all_spans = stored(all_spans, "spans")
    shared = documents.sparkSession.sparkContext.broadcast(bits_of(all_spans, "row"))

    @F.pandas_udf("boolean")
    def maybe(row):
        import pandas as pd

        return pd.Series(passes(shared.value, row.to_numpy()))

    @F.pandas_udf("string")
    def new(text, items):
        import pandas as pd

        return pd.Series([t if s is None or t is None else replaced(t, [(x["start"], x["kind"], x["end"]) for x in s]) for t, s in zip(text, items, strict=True)])

    def work(documents: DataFrame) -> DataFrame:
        kept = [F.col(f"`{c}`") for c in documents.columns]
        rows = documents.withColumn("_row", F.xxhash64("doc_id", "text")).withColumn("_maybe", maybe("_row"))
        met = rows.filter("_maybe").join(all_spans.toDF("_row", "_spans"), "_row", "left")
        met = met.withColumn("text", new(F.col("text").cast("string"), "_spans"))
        return rows.filter("not _maybe").select(*kept).unionByName(met.select(*kept))

    return apart(documents, work)
