"""Small documents with every odd case, and brute-force helpers."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `row` long, cid string, size int, kept boolean, n_hit int"

FILLER = [f"w{i}" for i in range(40)]


def odd_documents(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing column names."""
    base = " ".join(FILLER)
    texts = [
        (1, base, "en", "a"), (2, base, "en", "a"), (2, base, "en", "a"), (3, base + " extra", "en", "b"),
        (None, base, None, None), (4, None, "en", "a"), (5, "", "en", None), (6, " \t\n ", None, "b"), (7, "one", "de", "b"),
        (7, "two three", "de", "c"), (8, "long " * 60_000 + "end", "en", "c"), (9, "été à la mer " * 30, "fr", "c"),
        (10, "Mail me: Ann.Lee@example.org, or call +1 (212) 555-0199 x", "en", "a"),
    ]
    rows = [(i, t, lang, s, None if t is None else len(t), 1, "x", 2, None, 3) for i, t, lang, s in texts]
    return spark.createDataFrame(rows, SCHEMA)


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
