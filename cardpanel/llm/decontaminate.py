"""Benchmark decontamination by Wu-Manber search over words.

The patterns are the benchmark's windows of 13 consecutive words (an item of
fewer words is one window).  Patterns of one length share a matcher: a table of
word pairs says how far the search may move on (12 words at most), pairs that
end a pattern select a bucket by their hash, the bucket's prefix pairs select
test strings, and a direct comparison confirms an occurrence.

Benchmark items come in blocks of a bounded number of words, so tasks hold one
block's tables at a time however large the benchmark is; every block scans
every whole text.

Defined results: null and wordless texts have no words, no hit and no items;
repeated documents and repeated ids each keep their row; repeated items (one
item_id) count once; an item without id makes hits but is not listed; wordless
items match nothing; an empty benchmark leaves every document clean.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardpanel.llm.tables import apart
from cardpanel.llm.tokens import NON_ALNUM, buffers

WINDOW = 13
#: Benchmark words in a block: bounds the broadcast tables (about 1 kB a window at most).
BLOCK_WORDS = 200_000

_FOLD = bytes(0x20 if NON_ALNUM[i] and not 0x41 <= i <= 0x5A else i + 32 if 0x41 <= i <= 0x5A else i for i in range(256))


def words(text: bytes) -> list[bytes]:
    """Lower-cased words of a UTF-8 text."""
    return text.translate(_FOLD).split()


class WuManber:
    """All patterns of one length, in words."""

    def __init__(self, patterns: dict[tuple[bytes, ...], frozenset[str]]):
        self.m = m = len(next(iter(patterns)))
        self.block = b = min(2, m)
        self.far = m - b + 1
        self.shift: dict[tuple, int] = {}
        self.buckets: dict[tuple, dict[tuple, list]] = {}
        for p, ids in patterns.items():
            for end in range(b, m + 1):
                key = p[end - b : end]
                self.shift[key] = min(self.shift.get(key, self.far), m - end)
            self.buckets.setdefault(p[m - b :], {}).setdefault(p[:b], []).append((list(p), ids))

    def search(self, text: list[bytes]) -> Iterator[tuple[int, frozenset[str]]]:
        """(first word, item ids) of every occurrence."""
        m, b, far, shift, i, n = self.m, self.block, self.far, self.shift.get, self.m, len(text)
        while i <= n:
            key = (text[i - 2], text[i - 1]) if b == 2 else (text[i - 1],)
            step = shift(key, far)
            if step:
                i += step
                continue
            at = i - m
            for pattern, ids in self.buckets[key].get(tuple(text[at : at + b]), ()):
                if text[at:i] == pattern:
                    yield at, ids
            i += 1


def matchers(items: list[tuple[str | None, bytes]], window: int = WINDOW) -> list[WuManber]:
    by_length: dict[int, dict[tuple, set]] = {}
    for item, text in items:
        w = words(text)
        k = min(window, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            by_length.setdefault(k, {}).setdefault(tuple(w[i : i + k]), set()).update([] if item is None else [item])
    return [WuManber({p: frozenset(ids) for p, ids in ps.items()}) for _, ps in sorted(by_length.items())]


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(ranges):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def _blocks(benchmark: DataFrame, block_words: int) -> Iterator[list[tuple[str | None, bytes]]]:
    block, size = [], 0
    for item, text in benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("binary")).toLocalIterator():
        block.append((item, bytes(text or b"")))
        size += 1 + len(text or b"") // 6
        if size >= block_words:
            yield block
            block, size = [], 0
    if block:
        yield block


def hits(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``documents`` with ``_llm_words`` (number of words), ``_llm_hits`` (first and
    end word of each merged hit range, flat) and ``_llm_items`` (sorted item ids
    with occurring windows).  Adds no shuffle; one scan per benchmark block."""
    names = documents.columns
    out = documents.selectExpr(*[f"`{c}`" for c in names], "0L as _llm_words", "cast(array() as array<bigint>) as _llm_hits",
                               "cast(array() as array<string>) as _llm_items")
    sc = documents.sparkSession.sparkContext
    for block in _blocks(benchmark, block_words):
        out = out.mapInArrow(_scan(sc.broadcast(block), window, names.index("text"), len(names)), out.schema)
    return out


def _scan(items, window: int, text_at: int, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = matchers(items.value, window)
        for batch in batches:
            data, offsets = buffers(batch.column(text_at))
            count, ranges, listed = [], batch.column(n + 1).to_pylist(), batch.column(n + 2).to_pylist()
            for i in range(batch.num_rows):
                w = words(data[offsets[i] : offsets[i + 1]].tobytes())
                count.append(len(w))
                new = [(at, at + f.m, ids) for f in found for at, ids in f.search(w)]
                if new:
                    old = list(zip(ranges[i][::2], ranges[i][1::2], strict=True))
                    ranges[i] = [x for r in merged(old + [(a, b) for a, b, _ in new]) for x in r]
                    listed[i] = sorted(set(listed[i]).union(*(ids for _, _, ids in new)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:n], pa.array(count, pa.int64()), pa.array(ranges, pa.list_(pa.int64())),
                 pa.array(listed, pa.list_(pa.string()))], schema=batch.schema)

    return run


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated (a hit, and at least a twentieth of the words hit)."""
    found = hits(documents.select("doc_id", "text"), benchmark, window)
    return _judged(found).select(
        "doc_id", F.col("_llm_words").alias("n_words"), F.col("_llm_hit").alias("n_hit"), F.size("_llm_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("_llm_items", ","), 256).alias("items_sha256"), F.col("_llm_bad").alias("contaminated"))


def _judged(found: DataFrame) -> DataFrame:
    total = F.expr("aggregate(transform(_llm_hits, (x, i) -> if(i % 2 = 0, -x, x)), 0L, (a, x) -> a + x)")
    return found.withColumn("_llm_hit", total).withColumn(
        "_llm_bad", (F.col("_llm_hit") > 0) & (20 * F.col("_llm_hit") >= F.col("_llm_words")))


def clean_documents(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``documents`` without the contaminated ones, all columns kept."""
    def kept(rows: DataFrame) -> DataFrame:
        return _judged(hits(rows, benchmark, window)).filter(~F.col("_llm_bad"))

    return apart(documents, kept)
