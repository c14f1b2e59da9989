from __future__ import annotations

import hashlib
import random
import re

from cardpanel.llm import decontaminate as D

from .odd import odd_documents

WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text, items):
    w = WORDS.findall(bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()))
    hit, ids = set(), set()
    for item, t in items:
        v = WORDS.findall(bytes(b + 32 if 65 <= b <= 90 else b for b in (t or "").encode()))
        k = min(13, len(v))
        for i in range(len(v) - k + 1 if k else 0):
            for j in range(len(w) - k + 1):
                if w[j:j + k] == v[i:i + k]:
                    hit.update(range(j, j + k))
                    ids.add(str(item))
    return len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)


def test_equals_brute_force_in_any_blocks(spark, monkeypatch):
    rng = random.Random(1)
    vocabulary = ["a", "b", "c", "dé", "E5"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 3, 12, 13, 14, 20])))) for i in range(12)] + [(12, None), (13, " .,"), (3, "a b")]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(0, 60)))) for i in range(40)] + [(50, items[5][1].upper() + "!"), (51, None)]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = {i: brute(t, items) for i, t in docs}
    for block in (D.BLOCK_WORDS, 2):
        monkeypatch.setattr(D, "BLOCK_WORDS", block)
        found = D.hits(d.select("doc_id", "text"), b, block_words=block)
        got = {r.doc_id: tuple(r)[1:] for r in D._judged(found).selectExpr(
            "doc_id", "_llm_words", "_llm_hit", "size(_llm_items)", "sha2(array_join(_llm_items, ','), 256)", "_llm_bad").collect()}
        assert got == want


def test_odd_documents(spark):
    docs = odd_documents(spark)
    bench = spark.createDataFrame([(1, "one"), (None, "two three")], "item_id long, text string")
    rows = D.contamination(docs, bench).collect()
    assert len(rows) == docs.count()
    found = {(r.doc_id, r.n_words): (r.n_hit, r.n_items, r.contaminated) for r in rows}
    assert found[7, 1] == (1, 1, True) and found[7, 2] == (2, 0, True) and found[4, 0] == (0, 0, False)
    kept = D.clean_documents(docs, bench)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 2
    assert D.contamination(docs, bench.limit(0)).filter("contaminated").count() == 0
    assert D.contamination(docs.limit(0), bench).count() == 0
