"""Toxicity by weak supervision.

1. Lexicons are mined from labelled training documents: words and word stems
   (their first 3 to 6 letters) whose document frequency speaks for the label.
2. Voters look at a document: slices of the lexicons and a fixed list of insults
   vote toxic on a hit, each whole lexicon votes clean on silence, and patterns
   (hit density, several different hits, shouting, exclamations, symbols) vote
   either way.  All others abstain.
3. A generative model of votes given the unseen label is fitted by expectation
   maximisation to a sample of all training documents, labelled or not: every
   voter's chance to vote toxic, clean or not at all under either label.
   Correlations of votes left within the labels shrink a voter's evidence: one
   of k voters that say the same counts about 1/k.  Given labels only start it
   and check it; they are no votes.
4. A logistic classifier over lexicon entries and densities is trained on the
   model's posterior labels and scores every whole text.

The lexicons come from all labelled training documents (equal texts once); the
label model and the classifier are fitted on about ``SAMPLE`` training documents (by
id hash), on ``ENTRIES`` lexicon entries.  Insults are one more feature.  Labels come
from training rows only; a score sees nothing but the text.

Defined results: null and empty texts are scored by the classifier's intercept;
labels that are null are not used; several labels of a document count each;
without labels of both kinds every score is the share of toxic labels (0 without
any); repeated rows keep their rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardpanel.llm.filters import BITS, bits_of, passes
from cardpanel.llm.tables import about, fold_of, stored
from cardpanel.llm.tokens import LOWER, NON_ALNUM, Words, hashes, word_slices, words

SAMPLE, ENTRIES, STEMS, SLICES = 20_000, 4096, (3, 4, 5, 6), 6
LEAST, G2, ABOVE = 3, 13.0, 0.3
#: Correlations below this are taken for chance.
CORRELATED = 0.25
KINDS = 1 + len(STEMS)  # whole words and stems
U = np.uint64

# A small list of common English insults.
INSULTS = ["clown", "disgusting", "dumb", "fool", "garbage", "idiot", "jerk", "loser", "moron", "pathetic", "scum", "stupid", "trash", "worthless"]
_text = " ".join(INSULTS).encode()
INSULT_HASHES = np.sort(words(np.frombuffer(_text, np.uint8), np.array([0, len(_text)]), NON_ALNUM, LOWER).hash)


def entries(w: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """(hash, text number) of the words and of the stems of each length; words
    no longer than a stem have none.  A stem never equals a word's hash."""
    doc = w.doc()
    out = [(w.hash, doc)]
    lead = np.flatnonzero((w.data & 0xC0) != 0x80)
    letter = np.cumsum((w.data & 0xC0) != 0x80) - 1
    for k, n in enumerate(STEMS):
        at = letter[w.start] + n if len(w.start) else np.empty(0, np.int64)
        stop = np.where(at < len(lead), lead[np.minimum(at, len(lead) - 1)], len(w.data)) if len(lead) else at
        long = stop < w.end
        out.append((hashes(w.data, w.start[long], stop[long], LOWER) ^ U(0xA5A5_0000_0000_0001 * (k + 1) & ((1 << 64) - 1)), doc[long]))
    return out


def _shape(w: Words) -> np.ndarray:
    """Pattern statistics of each text: words, shares of capitals, exclamations and symbols."""
    def per(flags):
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[w.offsets[1:]] - total[w.offsets[:-1]]

    d, n, size = w.data, w.counts(), np.maximum(np.diff(w.offsets), 1)
    symbols = np.isin(d, np.frombuffer(b"#*$%&|<>", np.uint8))
    return np.column_stack([n, per((d >= 0x41) & (d <= 0x5A)) / size, per(d == 0x21) / size, per(symbols) / size]).astype(float)


@dataclass
class Lexicon:
    """Entries by hash, sorted; ``kind`` 0 is words, 1 and up the stems."""

    hash: np.ndarray
    kind: np.ndarray
    bits: np.ndarray

    @staticmethod
    def of(hash_: np.ndarray, kind: np.ndarray) -> Lexicon:
        order = np.argsort(hash_)
        bits = np.zeros(BITS // 64, U)
        place = (hash_ % U(BITS)).astype(np.int64)
        np.bitwise_or.at(bits, place >> 6, U(1) << (place & 63).astype(U))
        return Lexicon(hash_[order], kind[order], bits)

    def hits(self, w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text number, entry, occurrences), each text's entries once."""
        texts, found = [], []
        for h, doc in entries(w) if len(self.hash) else ():
            on = passes(self.bits, h)
            h, doc = h[on], doc[on]
            at = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
            same = self.hash[at] == h
            texts.append(doc[same])
            found.append(at[same])
        if not texts:
            return (np.empty(0, np.int64),) * 3
        both, n = np.unique(np.concatenate(texts) * len(self.hash) + np.concatenate(found), return_counts=True)
        return both // len(self.hash), both % len(self.hash), n


def _gold(labels: DataFrame, train: Column) -> DataFrame:
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).filter(train)
    return known.select(F.col("doc_id").alias("id"), (F.col("toxic") == 1).alias("y"))


def _labelled(documents: DataFrame, labels: DataFrame, train: Column) -> DataFrame:
    """(id, y, text) of all labelled training documents, equal texts once.  Which they
    are is decided on ids and text hashes; then only their texts move, once, and by the
    same kind of join at any size."""
    rows = documents.filter(train).select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("t"), F.xxhash64("doc_id", "text").alias("row"), F.col("text").cast("string"))
    known = rows.select("id", "t", "row").join(_gold(labels, train), "id")
    known = stored(known.groupBy("t", "y").agg(F.min(F.struct("id", "row")).alias("least")).select("y", "least.id", "least.row"), "toxic-known")
    wanted = documents.sparkSession.sparkContext.broadcast(bits_of(known, "row"))

    def run(batches):
        bits = wanted.value
        for batch in batches:
            yield batch.filter(pa.array(passes(bits, batch.column(0).to_numpy())))

    texts = rows.select("row", "text").mapInArrow(run, "row long, text string")
    texts = texts.join(known.hint("merge"), "row").groupBy("row", "y").agg(F.first("id").alias("id"), F.first("text").alias("text"))
    return stored(texts.select("id", "y", "text"), "toxic-labelled")


def _mined(labelled: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, kind) of the entries that speak most for the label, by document frequency."""

    def run(batches):
        for batch in batches:
            y = batch.column(0).to_numpy(zero_copy_only=False)
            for lo, hi, w in word_slices(batch.column(1), NON_ALNUM, LOWER):
                for kind, (h, doc) in enumerate(entries(w)):
                    order = np.lexsort((doc, h))
                    h, doc = h[order], doc[order]
                    new = np.ones(len(h), bool)
                    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
                    key, at, n = np.unique(h[new], return_index=True, return_counts=True)
                    bad = np.add.reduceat(y[lo:hi][doc[new]].astype(np.int64), at) if len(at) else at
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(np.full(len(key), kind, np.int32)), pa.array(bad.astype(np.int64)), pa.array(n.astype(np.int64))],
                                                     ["h", "kind", "bad", "n"])

    total = labelled.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.col("y").cast("long")), F.lit(0)).alias("bad")).first()
    rows = labelled.select("y", "text").mapInArrow(run, "h long, kind int, bad long, n long").groupBy("h", "kind").agg(F.sum("bad").alias("a"), F.sum("n").alias("n"))
    part = lambda x, e: F.when(x > 0, x * F.log(x / e)).otherwise(0.0)
    share = total["bad"] / max(total["n"], 1)
    a, n = F.col("a"), F.col("n")
    rows = rows.filter((a >= LEAST) & (a >= 0.8 * n)).withColumn("g2", 2 * (part(a, n * share) + part(n - a, n * (1 - share))))
    best = rows.filter(F.col("g2") >= G2).orderBy(F.desc("g2"), "h", "kind").limit(size).toArrow()
    return best["h"].to_numpy().view(U), best["kind"].to_numpy()


def _hits_of(sample: DataFrame, lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], list[np.ndarray], np.ndarray]:
    """The sample's documents, without their texts: shares of toxic labels (nan: no label),
    shapes, entries, occurrences, insult hits."""
    shared = sample.sparkSession.sparkContext.broadcast((lexicon.hash, lexicon.kind, lexicon.bits))

    def run(batches):
        lex = Lexicon(*shared.value)
        for batch in batches:
            for lo, hi, w in word_slices(batch.column(2), NON_ALNUM, LOWER):
                text, entry, n = lex.hits(w)
                ends = np.searchsorted(text, np.arange(w.n + 1)).astype(np.int32)
                insults = insults_of(w)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(list(_shape(w)), pa.list_(pa.float64())),
                     pa.ListArray.from_arrays(ends, pa.array(entry.astype(np.int32))), pa.ListArray.from_arrays(ends, pa.array(n.astype(np.int32))),
                     pa.array(insults.astype(np.int64))], ["id", "y", "shape", "entries", "n", "insults"])

    t = sample.select("id", "y", "text").mapInArrow(run, "id long, y double, shape array<double>, entries array<int>, n array<int>, insults long")
    t = t.toArrow().sort_by([("id", "ascending"), ("insults", "ascending")])
    return (t["y"].to_numpy(), np.array(t["shape"].to_pylist(), float).reshape(-1, 4), [np.array(x, np.int64) for x in t["entries"].to_pylist()],
            [np.array(x, np.int64) for x in t["n"].to_pylist()], t["insults"].to_numpy())


def votes(shape: np.ndarray, entry: list[np.ndarray], n: list[np.ndarray], insults: np.ndarray, lexicon: Lexicon) -> np.ndarray:
    """The votes of every voter (columns) on every document: 1 toxic, -1 clean, 0 none."""
    slice_ = lexicon.kind * SLICES + (lexicon.hash % U(SLICES)).astype(np.int64)
    out = np.zeros((len(entry), KINDS * (SLICES + 1) + 6), np.int8)
    for i, e in enumerate(entry):
        out[i, slice_[e]] = 1
        out[i, KINDS * SLICES + np.setdiff1d(np.arange(KINDS), lexicon.kind[e])] = -1
    at = KINDS * (SLICES + 1)
    size = np.maximum(shape[:, 0], 1)
    different = np.array([len(e) for e in entry])
    dense = np.array([x.sum() for x in n]) / size
    out[:, at] = np.where(insults > 0, 1, 0)
    out[:, at + 1] = np.where(different >= 3, 1, np.where(different == 0, -1, 0))
    out[:, at + 2] = np.where(dense >= 0.01, 1, np.where(dense < 0.001, -1, 0))
    out[:, at + 3] = np.where(shape[:, 1] > 0.3, 1, 0)
    out[:, at + 4] = np.where(shape[:, 2] > 0.02, 1, 0)
    out[:, at + 5] = np.where(shape[:, 3] > 0.05, -1, 0)
    return out


@dataclass
class LabelModel:
    """Chances of each voter's vote (-1, 0, 1) under either label, and its weight among correlated voters."""

    prior: float
    chance: np.ndarray  # label, voter, vote + 1
    weight: np.ndarray

    def posterior(self, v: np.ndarray) -> np.ndarray:
        each = np.log(self.chance[1]) - np.log(self.chance[0])
        score = np.log(self.prior / (1 - self.prior)) + sum(self.weight[j] * each[j, v[:, j] + 1] for j in range(v.shape[1]))
        return 1 / (1 + np.exp(-np.clip(score, -30, 30)))


def maximised(v: np.ndarray, p: np.ndarray) -> LabelModel:
    """The label model of votes whose documents are toxic with chances ``p``; correlations
    are those of the votes left within the labels."""
    onehot = np.stack([v == k for k in (-1, 0, 1)], 2).astype(float)
    prior = float(np.clip(p.mean(), 1e-3, 1 - 1e-3))
    chance = np.stack([(np.einsum("d,dvk->vk", w, onehot) + 0.1) / (w.sum() + 0.3) for w in (1 - p, p)])
    expected = np.einsum("dl,lvk->dvk", np.column_stack([1 - p, p]), chance)
    rest = v - (expected[:, :, 2] - expected[:, :, 0])
    spread = np.sqrt((rest**2).mean(0)) + 1e-6
    correlation = (rest.T @ rest) / len(v) / np.outer(spread, spread)
    strong = np.where(np.abs(correlation) >= CORRELATED, np.abs(correlation), 0.0)
    return LabelModel(prior, chance, 1 / np.maximum(1.0, strong.sum(1)))


def fit_label_model(v: np.ndarray, start: np.ndarray, rounds: int = 25) -> LabelModel:
    """Expectation maximisation from soft labels ``start``."""
    p, model = start.astype(float), maximised(v, start.astype(float))
    for _ in range(rounds):
        model = maximised(v, p)
        new = model.posterior(v)
        if np.abs(new - p).max() < 1e-4:
            break
        p = new
    return model


def anchored(v: np.ndarray, gold: np.ndarray) -> LabelModel:
    """The label model of all votes.  Labels (nan: none) only say which way votes point:
    they start it and are no votes.  If what it comes to agrees less with the labels than
    the start did, the start is kept."""
    known = ~np.isnan(gold)
    first = maximised(v[known], gold[known])
    last = fit_label_model(v, first.posterior(v))
    loss = [-np.mean(np.log(np.where(gold[known] > 0.5, q, 1 - q) + 1e-9)) for q in (m.posterior(v[known]) for m in (first, last))]
    return last if loss[1] <= loss[0] else first


@dataclass
class Classifier:
    """Weights of the lexicon's entries, of four densities and of insults, and an intercept."""

    lexicon: Lexicon
    entry: np.ndarray
    dense: np.ndarray
    intercept: float

    def scores(self, w: Words) -> np.ndarray:
        text, entry, n = self.lexicon.hits(w)
        out = np.full(w.n, self.intercept)
        out += np.bincount(text, self.entry[entry], minlength=w.n) if len(text) else 0
        out += densities(text, n, w.counts(), insults_of(w)) @ self.dense
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def insults_of(w: Words) -> np.ndarray:
    """Occurrences of listed insults in each text."""
    return np.bincount(w.doc()[np.isin(w.hash, INSULT_HASHES)], minlength=w.n)


def densities(text: np.ndarray, n: np.ndarray, size: np.ndarray, insults: np.ndarray) -> np.ndarray:
    different = np.bincount(text, minlength=len(size))
    every = np.bincount(text, n, minlength=len(size))
    return np.column_stack([np.log1p(different), np.minimum(different, 3), np.log1p(100 * every / np.maximum(size, 1)), different == 0, np.minimum(insults, 3)]).astype(float)


def train(entry: list[np.ndarray], n: list[np.ndarray], size: np.ndarray, target: np.ndarray, lexicon: Lexicon, insults: np.ndarray, rounds: int = 400) -> Classifier:
    """Logistic regression on soft targets by gradient descent with momentum."""
    text = np.repeat(np.arange(len(entry)), [len(e) for e in entry])
    at, times = (np.concatenate([*x, np.empty(0, np.int64)]).astype(np.int64) for x in (entry, n))
    dense = densities(text, times, size, insults)
    w, d, b = np.zeros(len(lexicon.hash)), np.zeros(dense.shape[1]), 0.0
    mw, md, mb, rate = 0 * w, 0 * d, 0.0, 0.5
    for _ in range(rounds):
        z = b + dense @ d + np.bincount(text, w[at], minlength=len(entry))
        g = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - target
        mw = 0.9 * mw + np.bincount(at, g[text], minlength=len(w)) / len(entry) + 1e-4 * w
        md = 0.9 * md + dense.T @ g / len(entry) + 1e-4 * d
        mb = 0.9 * mb + g.mean()
        w, d, b = w - rate * mw, d - rate * md, b - rate * mb
    return Classifier(lexicon, w, d, float(b))


def fit(documents: DataFrame, labels: DataFrame, train_rows: Column, sample: int = SAMPLE) -> Classifier:
    lexicon = Lexicon.of(*_mined(_labelled(documents, labels, train_rows), ENTRIES))
    gold = _gold(labels, train_rows).groupBy("id").agg(F.avg(F.col("y").cast("double")).alias("y"))
    drawn = about(documents.filter(train_rows & F.col("doc_id").isNotNull()), "doc_id", sample, "toxic")
    drawn = drawn.select(F.col("doc_id").alias("id"), F.col("text").cast("string")).join(gold, "id", "left").withColumn("y", F.coalesce("y", F.lit(float("nan"))))
    y, shape, entry, n, insults = _hits_of(drawn, lexicon)
    known = y[~np.isnan(y)]
    if not len(known) or known.min() == known.max():
        share = float(known.mean()) if len(known) else 0.0
        return Classifier(Lexicon.of(np.empty(0, U), np.empty(0, np.int64)), np.empty(0), np.zeros(5), 30.0 if share > 0.5 else -30.0)
    v = votes(shape, entry, n, insults, lexicon)
    return train(entry, n, shape[:, 0], anchored(v, y).posterior(v), lexicon, insults)


def scored(documents: DataFrame, classifier: Classifier) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    c = classifier
    shared = documents.sparkSession.sparkContext.broadcast((c.lexicon.hash, c.lexicon.kind, c.lexicon.bits, c.entry, c.dense, c.intercept))

    def run(batches):
        h, kind, bits, entry, dense, intercept = shared.value
        model = Classifier(Lexicon(h, kind, bits), entry, dense, intercept)
        for batch in batches:
            for lo, hi, w in word_slices(batch.column(2), NON_ALNUM, LOWER):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(model.scores(w))], ["doc_id", "held_out", "score"])

    rows = documents.select("doc_id", (fold_of("doc_id", 4) == 2).alias("held_out"), F.col("text").cast("string"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= ABOVE).cast("int"))


def toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all documents by a classifier fitted on rows whose crc32 modulo 4 isn't 2."""
    return scored(documents, fit(documents, labels, fold_of("doc_id", 4) != 2))
