from __future__ import annotations

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from cardpanel.llm import tokens as T


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAb \t\n\x0b\x1cé漢.", max_size=30)), max_size=8))
def test_words_are_those_of_bytes_split(texts):
    w = T.words(*T.buffers(pa.array(texts, pa.string())), fold=T.LOWER)
    d = w.data.tobytes()
    got = [[d[s:e] for s, e in zip(w.start[w.first[i]:w.first[i + 1]], w.end[w.first[i]:w.first[i + 1]])] for i in range(w.n)]
    assert got == [(t or "").encode().split() for t in texts]
    seen = {}
    for word, h in zip([x.lower() for row in got for x in row], w.hash):
        assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


def test_hash_does_not_depend_on_place_or_piece(monkeypatch):
    text = "alpha beta gamma " * 2000 + "x" * 5000
    whole = T.words(*T.buffers(pa.array([text]))).hash
    monkeypatch.setattr(T, "PIECE", 1000)
    monkeypatch.setattr(T, "_POW", T._powers(T._P, 1000))
    monkeypatch.setattr(T, "_INV", T._powers(T._P_INV, 1000))
    assert (T.words(*T.buffers(pa.array([text]))).hash == whole).all()


def test_slices_cover_all_rows():
    offsets = np.cumsum([0, 5, 0, 100, 3, 0])
    assert list(T.slices(offsets, 10)) == [(0, 2), (2, 3), (3, 5)]
    assert list(T.slices(np.array([0]), 10)) == []
