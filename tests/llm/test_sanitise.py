from __future__ import annotations

import hashlib
import math
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cardpanel.llm import sanitise as S

from .odd import odd_documents


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(d[::-1])) % 10 == 0


def brute(t):
    """The contract's patterns, as they stand."""
    out = [(m.start(), m.end(), 0) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), m.end(), 1) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m.group().split("."))]
    for pattern, kind, lo, hi in ((r"[0-9]([\x20-]?[0-9])+", 2, 14, 19), (r"\+[0-9][\x20().0-9-]+[0-9]", 3, 10, 15)):
        for m in re.finditer(pattern, t):
            d = re.sub("[^0-9]", "", m.group())
            if lo <= len(d) <= hi and (kind == 3 or luhn(d)):
                out.append((m.start(), m.end(), kind))
    return sorted((s, k, e) for s, e, k in out)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(["a@b.c", "x", "@", ".", "..", "1.2.3.4", "255.1.1.300", "4111 1111 1111 1111", "4111-1111", "+1 (212) 555-0199", "+", " ", "-", "é", "0",
                                 "12", "b.c", "%", "\n", "000255", "a.b@c-d.e.f@g.h"]), max_size=14).map("".join))
def test_patterns(text):
    chars = {0: 0}
    for i, c in enumerate(text):
        chars[len(text[: i + 1].encode())] = i + 1
    got = sorted((chars[s], k, chars[e]) for s, e, k, _ in S.values(text.encode()))
    assert got == brute(text)


def test_values_that_begin_together_are_in_order_of_kind():
    for text in ("4111111111111111@mail.com", "x +4915112345678@sms.de"):
        got = [(s, k, e) for s, e, k, _ in S.values(text.encode())]
        assert got == brute(text) and len(got) == 2


def test_patterns_are_linear_on_long_runs():
    for text in (b"a" * 300_000, b"1" * 300_000, b"1." * 150_000, b"@" * 200_000, b"+1 " * 100_000, b"a@" * 100_000, b"1 " * 200_000):
        S.values(text)


def test_disclosure_is_pmi_over_information(spark):
    rows = [(i, f"common word zorro{i % 2} me{i % 2}@x.org tail common {'zorro0 ' if i == 5 else ''}") for i in range(6)] + [(9, "common " * 200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    base = S.found(docs)
    near = base.selectExpr("row", "explode(near) x").select("row", "x.*")
    counts = S.term_counts(docs, near.select("t").distinct())
    got = {(r.e, r.t): r.disclosure for r in S.disclosures(near, counts).collect()}
    n = sum(len(re.findall(r"[a-z0-9]+", t)) for _, t in rows)
    per = {}
    for r in near.collect():
        per.setdefault(r.e, {}).setdefault(r.t, 0)
        per[r.e][r.t] += 1
    c = {r.t: r.c for r in counts.collect()}
    for e, terms in per.items():
        information = -math.log(sum(terms.values()) / n)
        for t, k in terms.items():
            assert got[e, t] == pytest.approx((math.log(k / c[t]) + information) / information)
    assert max(got.values()) == pytest.approx(1.0) and min(got.values()) < 0.5


def test_spans_and_text(spark):
    docs = odd_documents(spark)
    rows = S.detected(docs).collect()
    assert len(rows) == docs.count()
    got = {(r.doc_id, r.n_email, r.n_phone): r for r in rows}
    own = got[10, 1, 1]
    text = "Mail me: Ann.Lee@example.org, or call +1 (212) 555-0199 x"
    want = ",".join(f"{S.KINDS[k]}:{s}:{e}" for s, k, e in brute(text))
    assert own.base_sha256 == hashlib.sha256(want.encode()).hexdigest() and set(want.split(",")) <= set(own.spans.split(","))
    assert all(r.spans == "" for r in rows if r.doc_id != 10)
    out = S.sanitised(docs)
    assert out.columns == docs.columns
    texts = {(r.doc_id, r.lang): r.text for r in out.collect()}
    assert "[EMAIL]" in texts[10, "en"] and "[PHONE]" in texts[10, "en"] and "Ann" not in texts[10, "en"] and texts[4, "en"] is None
    before, after = (sorted(str(tuple(r)) for r in x.filter("doc_id is null or doc_id != 10").collect()) for x in (docs, out))
    assert before == after
    assert S.detected(docs.limit(0)).count() == 0 and S.sanitised(docs.limit(0)).count() == 0


def test_replaced():
    kind = {k: i for i, k in enumerate(S.KINDS)}
    text = "call Bob 42 at 1.2.3.4 now"
    assert S.replaced(text, [(5, kind["removed"], 8), (9, kind["generalised"], 11), (15, kind["ip"], 22), (16, kind["card"], 20), (23, kind["generalised"], 26)]) == "call  [NUMBER] at [IP] [TERM]"
