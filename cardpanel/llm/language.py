"""Language identification by a bidirectional gated recurrent network over bytes.

Training (numpy, backpropagation through time) takes windows of ``SPAN`` bytes
from a bounded sample of labelled documents: per language about ``PER_LANGUAGE``
documents by id hash, ``WINDOWS`` windows of each at hash-drawn places of the whole
text, every position labelled with the document's language.  The sample is nearly
even between languages; the softmax is then set back to their shares in the table.

Prediction labels every byte of every whole text.  Texts are cut into windows of
``SPAN`` bytes; both directions first read ``MARGIN`` bytes beyond the window (nothing
beyond the text), so a position has context on either side.  A document's
probabilities are the mean of its letters' (bytes of ASCII letters and of other
scripts).

Defined results: null texts and texts without a letter are ``und`` with score 0;
ties go to the first language by code point; null languages and texts without a
letter are not learned from; without any labelled text every prediction is ``und``;
repeated rows keep their rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardpanel.llm import gru
from cardpanel.llm.tables import fold_of, in_task
from cardpanel.llm.tokens import buffers, slices

SPAN, MARGIN, HIDDEN = 112, 16, 8
PER_LANGUAGE, WINDOWS = 1500, 3
UPDATES, BATCH, RATE = 500, 128, 0.02
#: Windows a task labels at a time.
LANES = 2048
PAD = 256
F32 = np.float32

LETTER = np.zeros(256, bool)
LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


_ASCII_LETTER = re.compile(rb"[A-Za-z]")


def has_letter(text: bytes) -> bool:
    if _ASCII_LETTER.search(text):
        return True
    return not text.isascii() and any(c.isalpha() for c in text.decode("utf-8", "replace"))


class Tagger:
    """The network: two directions and a softmax over languages at every position."""

    def __init__(self, languages: list[str], params: dict | None = None, seed: int = 11):
        self.languages, n = languages, len(languages)
        rng = np.random.default_rng(seed)
        self.p = params or {f"{d}{k}": v for d in "fb" for k, v in gru.init(PAD + 1, HIDDEN, rng).items()} | {
            "W": (rng.normal(size=(2 * HIDDEN, n)) * 0.1).astype(F32), "w": np.zeros(n, F32)}

    def _of(self, d: str) -> dict[str, np.ndarray]:
        return {"X": self.p[d + "X"], "U": self.p[d + "U"]}

    def train(self, windows: np.ndarray, target: np.ndarray, updates: int = UPDATES, seed: int = 3) -> list[float]:
        """``windows`` (window, byte), ``target`` language of each."""
        rng, adam, losses = np.random.default_rng(seed), gru.Adam(self.p, RATE), []
        for u in range(updates):
            on = rng.integers(0, len(windows), BATCH)
            ids, y = windows[on].T.astype(np.int32), target[on]
            length = np.where(rng.random(len(on)) < 0.5, rng.integers(8, SPAN + 1, len(on)), SPAN)  # short texts, too
            ids = np.where(np.arange(SPAN)[:, None] < length, ids, PAD)
            zero = np.zeros((len(on), HIDDEN), F32)
            fr, br = (np.concatenate([np.zeros((1, len(on)), bool), x[:-1] == PAD]) for x in (ids, ids[::-1]))
            fs, fc = gru.forward(self._of("f"), ids, zero, fr)
            bs, bc = gru.forward(self._of("b"), ids[::-1], zero, br)
            states = np.concatenate([fs, bs[::-1]], 2).reshape(-1, 2 * HIDDEN)
            known = (ids != PAD).ravel()
            logit = states @ self.p["W"] + self.p["w"]
            logit -= logit.max(1, keepdims=True)
            logp = logit - np.log(np.exp(logit).sum(1, keepdims=True))
            at = np.tile(y, len(ids))
            losses.append(float(-logp[np.arange(len(at)), at][known].mean()))
            d = np.exp(logp)
            d[np.arange(len(at)), at] -= 1
            d *= (known / max(known.sum(), 1))[:, None].astype(F32)
            ds = (d @ self.p["W"].T).reshape(*ids.shape, 2 * HIDDEN)
            grads = {"W": states.T @ d, "w": d.sum(0)}
            for name, dstates, cache, seq, reset in (("f", ds[:, :, :HIDDEN], fc, ids, fr), ("b", ds[::-1, :, HIDDEN:], bc, ids[::-1], br)):
                for k, g in gru.backward(self._of(name), seq, cache, dstates, reset).items():
                    grads[name + k] = g
            adam.update(grads, 1.0 if u < updates // 2 else 0.25)
        return losses

    def positions(self, ids: np.ndarray) -> np.ndarray:
        """Language probabilities (position, window, language) of the windows' own
        ``SPAN`` bytes; ``ids`` (time, window) has ``MARGIN`` more on either side."""
        n, beyond = ids.shape[1], ids == PAD
        some = beyond.any(1)
        states = np.empty((SPAN, n, 2 * HIDDEN), F32)
        for d, times, lo in (("f", range(MARGIN + SPAN), 0), ("b", range(SPAN + 2 * MARGIN - 1, MARGIN - 1, -1), HIDDEN)):
            run, h = gru.Runner(self._of(d), n), np.zeros((n, HIDDEN), F32)
            for t in times:
                run.step(ids[t], h)
                if some[t]:  # the state is zero where the text begins
                    h[beyond[t]] = 0
                if MARGIN <= t < MARGIN + SPAN:
                    states[t - MARGIN, :, lo : lo + HIDDEN] = h
        p = states.reshape(-1, 2 * HIDDEN) @ self.p["W"]
        p += self.p["w"]
        np.clip(p, -30, 30, out=p)
        np.exp(p, out=p)
        p /= p.sum(1, keepdims=True)
        return p.reshape(SPAN, n, -1)

    def pooled(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean probabilities over the letters of each text (zero without letters)."""
        out, letters = np.zeros((len(offsets) - 1, len(self.languages))), np.zeros(len(offsets) - 1)
        n = -(-np.diff(offsets) // SPAN)
        doc = np.repeat(np.arange(len(n)), n)
        start = offsets[doc] + SPAN * (np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n))
        around = np.arange(-MARGIN, SPAN + MARGIN)[:, None]
        for lo in range(0, len(doc), LANES):
            d, at = doc[lo : lo + LANES], start[lo : lo + LANES] + around
            inside = (at >= offsets[d]) & (at < offsets[d + 1])
            ids = np.where(inside, data[np.clip(at, 0, len(data) - 1)].astype(np.intp), np.intp(PAD))
            own = slice(MARGIN, MARGIN + SPAN)
            weight = inside[own] & LETTER[np.minimum(ids[own], 255)]
            total = np.einsum("tnl,tn->nl", self.positions(ids), weight.astype(F32), optimize=False)
            for k in range(total.shape[1]):
                out[:, k] += np.bincount(d, total[:, k], minlength=len(out))
            letters += np.bincount(d, weight.sum(0), minlength=len(out))
        return out / np.maximum(letters, 1)[:, None]


def _windows(documents: DataFrame, train: Column) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """(languages, windows, target of each, documents of each language) of the training sample."""
    rows = documents.filter(train).filter("lang is not null and doc_id is not null").select("doc_id", F.col("lang").alias("_lang"))
    counts = sorted((r["_lang"], r["n"]) for r in rows.groupBy("_lang").agg(F.count("*").alias("n")).collect())
    if not counts:
        return [], np.empty((0, SPAN), np.int32), np.empty(0, np.int64), np.empty(0)
    languages = [k for k, _ in counts]
    share = documents.sparkSession.createDataFrame([(k, min(1.0, PER_LANGUAGE / n)) for k, n in counts], "_lang string, _share double")
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("lang")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    texts = documents.filter(train).select("doc_id", F.col("lang").alias("_lang"), "text").join(F.broadcast(share), "_lang").filter(drawn < F.col("_share"))

    def cut(batches):
        for batch in batches:
            data, offsets = buffers(batch.column(2))
            out = []
            for i, (key, lang) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                text = data[offsets[i] : offsets[i + 1]]
                if has_letter(text.tobytes()):
                    for k in range(WINDOWS):
                        at = (key * 7919 + k * 104_729) % max(1, len(text) - SPAN + 1)
                        out.append((key, k, lang, text[at : at + SPAN].tobytes()))
            columns = list(zip(*out, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.string()), pa.array(columns[3], pa.binary())],
                                             ["id", "k", "lang", "window"])

    t = texts.select(F.xxhash64("doc_id").alias("id"), "_lang", F.col("text").cast("string")).mapInArrow(cut, "id long, k int, lang string, window binary").toArrow()
    rows = sorted(zip(t["id"].to_pylist(), t["k"].to_pylist(), t["lang"].to_pylist(), t["window"].to_pylist(), strict=True))
    windows = np.full((len(rows), SPAN), PAD, np.int32)
    for i, (*_, w) in enumerate(rows):
        windows[i, : len(w)] = np.frombuffer(w, np.uint8)
    return languages, windows, np.array([languages.index(r[2]) for r in rows], np.int64), np.array([n for _, n in counts], float)


def fit(documents: DataFrame, train: Column) -> Tagger:
    languages, windows, target, counts = _windows(documents, train)
    if not len(windows):
        return Tagger([])

    def trained(data):
        languages, windows, target = data
        tagger = Tagger(languages)
        tagger.train(windows, target)
        seen = np.bincount(target, minlength=len(languages)) + 1.0
        tagger.p["w"] += (np.log(counts / counts.sum()) - np.log(seen / seen.sum())).astype(F32)
        return tagger.p

    return Tagger(languages, in_task(documents.sparkSession, trained, (languages, windows, target)))


def predicted(documents: DataFrame, tagger: Tagger) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    shared = documents.sparkSession.sparkContext.broadcast((tagger.languages, tagger.p))

    def run(batches):
        languages, params = shared.value
        tagger = Tagger(languages, params)
        for batch in batches:
            data, offsets = buffers(batch.column(2))
            for lo, hi in slices(offsets):
                best, score = ["und"] * (hi - lo), np.zeros(hi - lo)
                p = tagger.pooled(data, offsets[lo : hi + 1]) if languages else None
                for i in range(hi - lo):
                    if languages and has_letter(data[offsets[lo + i] : offsets[lo + i + 1]].tobytes()):
                        k = int(p[i].argmax())
                        best[i], score[i] = languages[k], min(1.0, p[i, k])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(best), pa.array(score)],
                                                 ["doc_id", "held_out", "lang_pred", "score"])

    rows = documents.select("doc_id", (fold_of("doc_id", 4) == 2).alias("held_out"), F.col("text").cast("string"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def languages(documents: DataFrame) -> DataFrame:
    """Predictions for all documents by a network fitted on rows whose crc32 modulo 4 isn't 2."""
    return predicted(documents, fit(documents, fold_of("doc_id", 4) != 2))
