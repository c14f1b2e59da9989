"""Language-model scores: a word-level gated recurrent network.

The vocabulary is the ``VOCABULARY`` most frequent training words, an unknown word
and an end.  The softmax is factored by class: the vocabulary in order of frequency
is cut into classes of equal size, and P(word | state) = P(class | state) *
P(word | class, state).  An unknown word that occurs in training shares the unknown
word's chance by frequency; all words that never occur are one more word, as in the
base score's V + 1, with the share that words occurring once have (Good-Turing), so
every text has a probability.  Training is truncated
backpropagation through time over windows whose first state is the one before;
scoring carries the state through whole documents, one document after another in
each lane of a batch, so no text is cut.

Counts cover all training documents.  Words travel as 64-bit hashes.  The counts of
the most frequent words (``HEAD`` at most) are broadcast; other words leave the
documents as (hash, occurrences) and meet their counts in a join, so no frequent
word is ever shuffled.  The fit reads every training document whole: ``ROUNDS``
rounds (fewer for small tables) have a share of the documents each, by hash; the
tasks of a round train copies on their own documents, whose parameters and moments
are averaged by tokens for the next round.  A task passes its documents as often as
``UPDATES`` updates over all rounds take, once at least; in the second half of all
updates steps are smaller.

Defined results: null reads as empty and has one token, the end; a null doc_id is
a training row; repeated rows each count and are each scored; without training
documents c, N and V are 0 and the network is its untrained start.
"""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardpanel.llm import gru
from cardpanel.llm.tables import fold_of, stored
from cardpanel.llm.tokens import LOWER, word_slices

VOCABULARY, CLASSES, HIDDEN, HEAD = 4094, 64, 24, 1 << 18
ROUNDS, PIECE = 8, 1 << 14
LANES, WINDOW = 512, 32
#: Lanes of the fit: the fewest and the most.
TRAIN_LANES, MOST_LANES, UPDATES, RATE = 64, 384, 500, 0.01
#: Rows of logits at a time; rows of a symbol that are added one by one.
BLOCK, FEW = 1024, 16
#: Words of a task counted at a time.
AT_ONCE = 1 << 21
U, F32 = np.uint64, np.float32
#: Kinds of counts: words, words in all, documents.
WORD, WORDS, DOCUMENTS = range(3)


# -- counts of all training documents --------------------------------------------------


def counts(documents: DataFrame) -> DataFrame:
    """(kind, key, c) over all documents."""

    def rows(kind, key, n):
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(key), kind, np.int32)), pa.array(key.view(np.int64)), pa.array(n.astype(np.int64))], ["kind", "key", "c"])

    def run(batches):
        n_docs, n_words, held = 0, 0, []
        for batch in batches:
            n_docs += batch.num_rows
            for _, _, w in word_slices(batch.column(0), fold=LOWER):
                held.append(w.hash)
                n_words += len(w.hash)
                if sum(map(len, held)) >= AT_ONCE:
                    yield rows(WORD, *np.unique(np.concatenate(held), return_counts=True))
                    held = []
        if held:
            yield rows(WORD, *np.unique(np.concatenate(held), return_counts=True))
        if n_docs:
            for kind, n in ((WORDS, n_words), (DOCUMENTS, n_docs)):
                yield rows(kind, np.zeros(1, np.int64), np.array([n]))

    found = documents.select(F.col("text").cast("string")).mapInArrow(run, "kind int, key long, c long")
    return found.groupBy("kind", "key").agg(F.sum("c").alias("c"))


# -- vocabulary ---------------------------------------------------------------------------


class Vocabulary:
    """Ids of words by hash.  Ids follow frequency: 0 is the unknown word, 1 the
    end, 2 and up the words; the symbol after the last id starts a document."""

    def __init__(self, by_frequency: np.ndarray):
        self.by_frequency = by_frequency
        self.order = np.argsort(by_frequency)
        self.hash = by_frequency[self.order]
        self.size = len(by_frequency) + 2
        # by the upper 16 bits: the id of the most frequent word that has them, and whether others do
        place = self._place(by_frequency)
        self.first, self.more = np.zeros(1 << 16, np.int32), np.bincount(place, minlength=1 << 16) > 1
        self.first[place[::-1]] = np.arange(len(by_frequency), dtype=np.int32)[::-1] + 2
        self.word = np.concatenate([np.zeros(2, U), by_frequency])

    @staticmethod
    def _place(h: np.ndarray) -> np.ndarray:
        return (h >> U(48)).astype(np.intp)

    def ids(self, h: np.ndarray) -> np.ndarray:
        place = self._place(h)
        out = self.first.take(place)
        other = self.word.take(out) != h
        out[other] = 0
        other &= self.more.take(place)
        on = np.flatnonzero(other)
        if len(on):
            at = np.minimum(np.searchsorted(self.hash, h[on]), len(self.hash) - 1)
            same = self.hash[at] == h[on]
            out[on[same]] = self.order[at[same]] + 2
        return out


# -- the network ----------------------------------------------------------------------------


class Network:
    """The recurrent network and its class-factored softmax."""

    def __init__(self, size: int, hidden: int = HIDDEN, classes: int = CLASSES, seed: int = 5, params: dict | None = None):
        self.size, self.hidden = size, hidden
        self.each = -(-size // classes)  # words of a class
        self.classes = -(-size // self.each)
        rng = np.random.default_rng(seed)
        self.p = params or gru.init(size + 1, hidden, rng) | {
            "C": np.zeros((hidden, self.classes), F32), "c": np.zeros(self.classes, F32),
            "W": (rng.normal(size=(self.classes, hidden, self.each)) * 0.1).astype(F32), "w": np.zeros((self.classes, self.each), F32)}

    def _tables(self) -> tuple[np.ndarray, np.ndarray, bool]:
        """Class and word weights with their biases as one more row, and whether logits
        may leave the range of exp (states are within -1 and 1)."""
        first = np.vstack([self.p["C"], self.p["c"]])
        words = np.concatenate([self.p["W"], self.p["w"][:, None, :]], 1)
        words[-1][:, self.size - (self.classes - 1) * self.each :] = 0  # places beyond the last word
        return first, words, float(max(np.abs(first).sum(0).max(), np.abs(words).sum(1).max())) > 60

    def _word_count(self, k: int) -> int:
        return min(self.each, self.size - k * self.each)

    @staticmethod
    def _log_chance(x: np.ndarray, at: np.ndarray, wide: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(logit of ``at`` in each row of logits, their exponentials, in place, their
        sums, and the flat places of ``at``): the log chance is the logit less the sum's log."""
        if wide:
            x -= x.max(1, keepdims=True)
        place = np.arange(0, x.size, x.shape[1])
        place += at
        picked = x.reshape(-1).take(place)
        np.exp(x, out=x)
        total = x @ (_ONES[: x.shape[1]] if x.dtype == F32 and x.shape[1] <= len(_ONES) else np.ones(x.shape[1], x.dtype))
        return picked, x, total, place

    def _softmaxes(self, edges: np.ndarray, first: np.ndarray, words: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, list[slice]]]:
        """(0 for classes or 1 for words, class, weights, blocks of rows) of every softmax that has rows in order of class."""
        yield 0, 0, first, list(_blocks(0, edges[-1]))
        for c in np.flatnonzero(np.diff(edges)):
            yield 1, int(c), words[c][:, : self._word_count(c)], list(_blocks(edges[c], edges[c + 1]))

    def _by_class(self, h: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """States (with a one for the bias) and ids in order of class, classes, their edges, the order."""
        k = ids // self.each
        order = np.argsort(k.astype(np.uint8) if self.classes <= 256 else k, kind="stable")
        states = np.ones((len(ids), self.hidden + 1), h.dtype)
        states[:, :-1] = h[order]
        k = k[order]
        return states, ids[order], k, np.searchsorted(k, np.arange(self.classes + 1)), order

    def log_chances(self, h: np.ndarray, ids: np.ndarray, tables: tuple[np.ndarray, np.ndarray, bool] | None = None) -> np.ndarray:
        """Natural log chance of each id in its state."""
        first, words, wide = tables or self._tables()
        h, ids, k, edges, order = self._by_class(h, ids)
        at, logit, total = (k, ids - k * self.each), np.empty((2, len(ids)), h.dtype), np.empty((2, len(ids)), h.dtype)
        logits = np.empty(BLOCK * max(first.shape[1], self.each), np.result_type(h, first))
        for i, _, weights, blocks in self._softmaxes(edges, first, words):
            for on in blocks:
                logit[i, on], _, total[i, on], _ = self._log_chance(_product(h[on], weights, logits), at[i][on], wide)
        logit -= np.log(total, out=total)
        out = np.empty_like(logit[0])
        out[order] = logit.sum(0)
        return out

    def gradients(self, h: np.ndarray, ids: np.ndarray) -> tuple[float, np.ndarray, dict[str, np.ndarray]]:
        """(mean loss, gradient of the states, gradients of the softmax)."""
        first, words, wide = self._tables()
        h, ids, k, edges, order = self._by_class(h, ids)
        n, scale, at = len(ids), h.dtype.type(1 / len(ids)), (k, ids - k * self.each)
        logit, total = (np.empty((2, n), h.dtype) for _ in range(2))
        logits = np.empty(BLOCK * max(first.shape[1], self.each), np.result_type(h, first))
        dh, first_grad, word_grad = np.empty((n, self.hidden), h.dtype), np.zeros_like(first), np.zeros_like(words)
        for i, c, weights, blocks in self._softmaxes(edges, first, words):
            back, grad = np.ascontiguousarray(weights[:-1].T), word_grad[c][:, : weights.shape[1]] if i else first_grad
            for on in blocks:
                rows = h[on]
                logit[i, on], d, sums, place = self._log_chance(_product(rows, weights, logits), at[i][on], wide)
                total[i, on] = sums
                d *= np.reciprocal(sums)[:, None]
                d.reshape(-1)[place] -= 1
                if i:
                    dh[on] += d @ back
                else:
                    np.matmul(d, back, out=dh[on])
                grad += rows.T @ d
        logit -= np.log(total, out=total)
        back = np.empty_like(dh)
        dh *= scale
        back[order] = dh
        first_grad *= scale
        word_grad *= scale
        return -float(logit.sum(dtype=float)) / n, back, {"C": first_grad[:-1], "c": first_grad[-1], "W": word_grad[:, :-1], "w": word_grad[:, -1]}

    def train(self, docs: list[np.ndarray], updates: int = UPDATES, lanes: int = TRAIN_LANES) -> list[float]:
        """Whole passes over ``docs`` in their order, as many as ``updates`` updates take, at least one."""
        tokens = sum(len(d) + 1 for d in docs)
        if not docs:
            return []
        passes = max(1, -(-updates * lanes * WINDOW // tokens))
        return self.learn(itertools.chain.from_iterable(itertools.repeat(docs, passes)), lanes, gru.Adam(self.p, RATE), passes * tokens // (2 * lanes * WINDOW))

    def learn(self, docs: Iterable[np.ndarray], lanes: int, adam: gru.Adam, late: int) -> list[float]:
        """Truncated backpropagation over every window of ``docs``, the state carried on
        within a text.  An update takes as many windows as fill the lanes, one while all
        have texts; its gradient counts by its share of known places; from update ``late``
        on steps are smaller."""
        losses, h = [], np.zeros((lanes, self.hidden), F32)
        for u, windows in enumerate(_full(streamed(docs, self.size, lanes), lanes)):
            runs, by_gate = [], gru.gates(self.p)
            for inp, _, live in windows:
                runs.append(gru.forward(self.p, np.maximum(inp, 0), h[live], inp == self.size, by_gate))
                h = runs[-1][0][-1]
            inp, out = (_beside([w[i] for w in windows], 1) for i in range(2))
            states, cache = _beside([s for s, _ in runs], 1), tuple(_beside(list(x), -2) for x in zip(*[c for _, c in runs], strict=True))
            flat, on = states.reshape(-1, self.hidden), (inp >= 0).ravel()
            if on.all():
                loss, dstates, grads = self.gradients(flat, out.ravel())
            else:
                loss, dflat, grads = self.gradients(flat[on], out.ravel()[on])
                dstates = np.zeros_like(flat)
                dstates[on] = dflat
            grads |= gru.backward(self.p, np.maximum(inp, 0), cache, dstates.reshape(states.shape), inp == self.size, added)
            adam.update(grads, 1.0 if u < late else 0.3, float(on.sum() / (lanes * WINDOW)))
            losses.append(loss)
        return losses

    def document_scores(self, docs: list[np.ndarray]) -> np.ndarray:
        """Natural log chance of every document (ids of its words; the end is added)."""
        inp, out, owner = laid(docs, self.size, LANES)
        scores, h = np.zeros(len(docs)), np.zeros((inp.shape[1], self.hidden), F32)
        run, tables = gru.Runner(self.p, inp.shape[1]), self._tables()
        at = 0
        while at < len(inp):
            live = int((inp[at] >= 0).sum())  # lanes are sorted by length
            w = slice(at, at + max(WINDOW, LANES * WINDOW // live))  # few lanes take longer windows
            ids, states = inp[w, :live], np.empty((len(inp[w]), live, self.hidden), F32)
            symbols, starts = np.maximum(ids, 0).astype(np.intp), ids == self.size
            some, h = starts.any(1), h[:live]
            for t in range(len(ids)):
                if some[t]:
                    h[starts[t]] = 0
                run.step(symbols[t], h)
                states[t] = h
            on = (ids >= 0).ravel()
            on = slice(None) if on.all() else on
            logp = self.log_chances(states.reshape(-1, self.hidden)[on], out[w, :live].ravel()[on], tables)
            scores += np.bincount(owner[w, :live].ravel()[on], logp, minlength=len(docs))
            at = w.stop
        return scores


_ONES = np.ones(1 << 10, F32)


def _product(a: np.ndarray, b: np.ndarray, buffer: np.ndarray) -> np.ndarray:
    """a @ b in the front of ``buffer``, which stays in a core's cache."""
    return np.matmul(a, b, out=buffer[: len(a) * b.shape[1]].reshape(len(a), b.shape[1]))


def _blocks(lo: int, hi: int) -> Iterator[slice]:
    """Rows ``lo`` to ``hi`` in slices whose logits stay in a core's cache."""
    for i in range(lo, hi, BLOCK):
        yield slice(i, min(i + BLOCK, hi))


def added(table: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """Adds each of ``rows`` to its row of ``table`` (numpy's add.at, by sorting)."""
    at = at.astype(np.uint16) if len(table) <= 1 << 16 else at
    order = np.argsort(at, kind="stable")
    at = at[order]
    first = np.flatnonzero(np.append(True, at[1:] != at[:-1])[: len(at)])
    to = at[first]
    count = np.diff(np.append(first, len(at)))
    for i in np.flatnonzero(count > FEW):  # frequent symbols: a product with ones
        own = order[first[i] : first[i] + count[i]]
        table[to[i]] += np.ones(len(own), rows.dtype) @ rows[own]
    few = count <= FEW
    to, first, count = to[few], first[few], count[few]
    for j in range(int(count.max(initial=0))):  # the others' first rows, second rows, ...
        left = count > j
        to, first, count = to[left], first[left], count[left]
        table[to] += rows[order[first + j]]


def streamed(docs: Iterable[np.ndarray], start: int, lanes: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(inputs, outputs, lanes kept since the window before) of windows as (time,
    lane): a lane takes the next document where its last one ends, so no more than
    one document a lane is held; -1 beyond the last, and lanes that are through leave."""
    docs, none = iter(docs), np.empty(0, np.int32)
    held = [(none, 0, 0)] * lanes  # a text between its start and its end, the places taken and in all
    first, last = np.array([start], np.int32), np.ones(1, np.int32)
    while held:
        inp, out = (np.full((len(held), WINDOW), -1, np.int32) for _ in range(2))
        for i, (a, done, size) in enumerate(held):
            if done + WINDOW <= size:
                inp[i], out[i] = a[done : done + WINDOW], a[done + 1 : done + WINDOW + 1]
                held[i] = a, done + WINDOW, size
                continue
            at = 0
            while at < WINDOW:
                if done == size:
                    doc = next(docs, None)
                    if doc is None:
                        break
                    a, done, size = np.concatenate([first, doc, last]), 0, len(doc) + 1
                n = min(WINDOW - at, size - done)
                inp[i, at : at + n], out[i, at : at + n] = a[done : done + n], a[done + 1 : done + n + 1]
                done, at = done + n, at + n
            held[i] = a, done, size
        live = np.flatnonzero(inp[:, 0] >= 0)
        if len(live):
            yield inp[live].T, out[live].T, live
        held = [held[i] for i in live]


def _full(windows: Iterable[tuple[np.ndarray, ...]], lanes: int) -> Iterator[list[tuple[np.ndarray, ...]]]:
    """Consecutive windows of ``lanes`` lanes together at most: long texts leave windows of
    few lanes, each of which would cost as much as a full one apart from the products."""
    held: list[tuple[np.ndarray, ...]] = []
    for w in windows:
        if held and sum(x[0].shape[1] for x in held) + w[0].shape[1] > lanes:
            yield held
            held = []
        held.append(w)
    if held:
        yield held


def _beside(parts: list[np.ndarray], axis: int) -> np.ndarray:
    return parts[0] if len(parts) == 1 else np.concatenate(parts, axis)


def laid(docs: list[np.ndarray], start: int, lanes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(inputs, outputs, document of each) as (time, lane): documents one after
    another in the lane that is free first; -1 beyond a lane's end."""
    size = np.array([len(d) + 1 for d in docs])
    lanes = max(1, min(lanes, int(size.sum() // size.max())))
    free, place = [(0, i) for i in range(lanes)], []
    for d in np.argsort(-size, kind="stable"):
        n, lane = heapq.heappop(free)
        place.append((d, lane, n))
        heapq.heappush(free, (n + int(size[d]), lane))
    lengths = np.zeros(lanes, np.int64)
    for n, lane in free:
        lengths[lane] = n
    rank = np.empty(lanes, np.int64)
    rank[np.argsort(-lengths, kind="stable")] = np.arange(lanes)
    inp, out, owner = (np.full((int(lengths.max()), lanes), -1, np.int32) for _ in range(3))
    for d, lane, n in place:
        to, lane = n + int(size[d]), rank[lane]
        inp[n, lane], inp[n + 1 : to, lane] = start, docs[d]
        out[n : to - 1, lane], out[to - 1, lane] = docs[d], 1
        owner[n:to, lane] = d
    return inp, out, owner


def _frequent(word_counts: DataFrame) -> pa.Table:
    """(key, c) of the most frequent words, ``HEAD`` at most: all above a count that
    a histogram of magnitudes gives (none where more words share the top one)."""
    magnitude = F.floor(F.log2("c") * 8).cast("int")
    sizes = word_counts.groupBy(magnitude.alias("m")).agg(F.count("*").alias("n")).orderBy(F.desc("m")).collect()  # 512 rows at most
    least, total = None, 0
    for r in sizes:
        total += r.n
        if total > HEAD:
            break
        least = r.m
    return word_counts.filter(magnitude >= least if least is not None else F.lit(False)).select("key", "c").toArrow()


# -- fitting and scoring ----------------------------------------------------------------------


def _texts(documents: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(at, ids) of every document: a hash and the ids of its words, two bytes each."""
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary.by_frequency)

    def run(batches):
        v = Vocabulary(shared.value)
        for batch in batches:
            for lo, hi, w in word_slices(batch.column(1), fold=LOWER):
                ids = v.ids(w.hash).astype(np.uint16)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array([ids[w.first[i] : w.first[i + 1]].tobytes() for i in range(w.n)], pa.binary())], ["at", "ids"])

    return documents.select(F.xxhash64("doc_id", "text", F.lit("lm")), F.col("text").cast("string")).mapInArrow(run, "at long, ids binary")


def _flat(parts: list[dict[str, np.ndarray]]) -> np.ndarray:
    return np.concatenate([d[k].ravel() for d in parts for k in sorted(d)])


def _filled(parts: list[dict[str, np.ndarray]], values: np.ndarray) -> None:
    """The inverse of ``_flat``, in place."""
    at = 0
    for d in parts:
        for k in sorted(d):
            d[k][...] = values[at : at + d[k].size].reshape(d[k].shape)
            at += d[k].size


def fitted(texts: DataFrame, tokens: int, size: int) -> tuple[dict[str, np.ndarray], int]:
    """(parameters, tokens read) of a network trained on all ``texts`` (at, ids), about ``tokens`` with their ends."""
    least = max(1, UPDATES * TRAIN_LANES * WINDOW)
    rounds = min(max(tokens // least, 1), ROUNDS)
    tasks = max(tokens // (rounds * least), 1)
    lanes = min(max(tokens // max(1, UPDATES * WINDOW), TRAIN_LANES), MOST_LANES)
    passes = max(1, -(-least // max(tokens, 1)))
    updates = passes * tokens / (rounds * tasks * lanes * WINDOW)  # of a task in a round, about
    network, read, steps = Network(size), 0, 0
    adam = gru.Adam(network.p, RATE)
    texts = stored(texts.withColumn("round", F.pmod("at", F.lit(rounds)).cast("int")), "lm-texts", by="round")
    for r in range(rounds):
        shared = texts.sparkSession.sparkContext.broadcast((network.p, adam.m, adam.v, steps))

        def run(batches, shared=shared, late=max(0, int((rounds / 2 - r) * updates))):
            p, m, v, t = shared.value
            net = Network(size, params={k: x.copy() for k, x in p.items()})
            own = gru.Adam(net.p, RATE)
            own.m, own.v, own.t = {k: x.copy() for k, x in m.items()}, {k: x.copy() for k, x in v.items()}, t
            n = 0

            def docs():
                nonlocal n
                for batch in batches:
                    for x in batch.column(0):
                        doc = np.frombuffer(x.as_py(), np.uint16).astype(np.int32)
                        n += len(doc) + 1
                        yield doc

            net.learn(docs() if passes == 1 else itertools.chain.from_iterable(itertools.repeat(list(docs()), passes)), lanes, own, late)
            if n:
                values = _flat([net.p, own.m, own.v])
                pieces = [values[i : i + PIECE].tobytes() for i in range(0, len(values), PIECE)]
                k, task = len(pieces), TaskContext.get().partitionId()
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(k, dtype=np.int32)), pa.array(np.full(k, task, np.int32)), pa.array(np.full(k, n, np.int64)),
                                                  pa.array(np.full(k, own.t, np.int64)), pa.array(pieces, pa.binary())], ["piece", "task", "n", "t", "x"])

        own = texts.filter(F.col("round") == r).coalesce(tasks).sortWithinPartitions("at").select("ids")
        rows = own.mapInArrow(run, PIECES)
        while tasks > 1:  # some tasks' pieces at a time, until one group is left
            rows = rows.withColumn("task", F.floor(F.col("task") / MERGED).cast("int")).groupBy("piece", "task").applyInArrow(_averaged, PIECES)
            tasks = -(-tasks // MERGED)
        tasks = max(tokens // (rounds * least), 1)
        pieces = sorted(rows.collect(), key=lambda x: x.piece)  # a row for each PIECE values of the network
        if pieces:
            _filled([network.p, adam.m, adam.v], np.concatenate([np.frombuffer(x.x, F32) for x in pieces]))
            read, steps = read + pieces[0].n, pieces[0].t
        shared.unpersist()
    return network.p, read


#: Rows of a network in pieces, and how many tasks' are averaged at once.
PIECES, MERGED = "piece int, task int, n long, t long, x binary", 32


def _averaged(rows: pa.Table) -> pa.Table:
    """The mean of a piece over some tasks, weighted by tokens."""
    rows = rows.sort_by("n")
    n = rows["n"].to_numpy()
    total = sum(w * np.frombuffer(x.as_py(), F32).astype(float) for w, x in zip(n, rows["x"], strict=True))
    return pa.table({"piece": rows["piece"].slice(0, 1), "task": rows["task"].slice(0, 1), "n": pa.array([int(n.sum())], pa.int64()),
                     "t": pa.array([int(rows["t"].to_numpy().max())], pa.int64()), "x": pa.array([(total / n.sum()).astype(F32).tobytes()], pa.binary())})


def scores(documents: DataFrame, held_out: Column) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score; ``held_out`` documents are not learned from."""
    rows = documents.select("doc_id", "text", held_out.alias("held_out"))
    train = rows.filter("not held_out")
    all_counts = stored(counts(train), "lm-counts")
    word_counts = all_counts.filter(F.col("kind") == WORD)
    by_kind = {(r.kind, r.key): r.c for r in all_counts.filter(F.col("kind") != WORD).collect()}
    n_docs, n_words = by_kind.get((DOCUMENTS, 0), 0), by_kind.get((WORDS, 0), 0)
    total, kinds = n_words + n_docs, word_counts.count() + (1 if n_docs else 0)
    head = _frequent(word_counts).sort_by([("c", "descending"), ("key", "ascending")])
    head_hash, head_count = head["key"].to_numpy().view(U), head["c"].to_numpy()
    once = word_counts.filter("c = 1").count()
    unknown = max(n_words - int(head_count[:VOCABULARY].sum()), 0)  # occurrences outside the vocabulary
    unseen = min(0.5, (once + 1) / (unknown + 2))
    vocabulary = Vocabulary(head_hash[:VOCABULARY])
    size = vocabulary.size

    network = Network(size, params=fitted(_texts(train, vocabulary), total, size)[0])
    scored = stored(_scored(rows, vocabulary, network, head_hash, head_count, n_docs, total + kinds + 1, np.log10((1 - unseen) / max(unknown, 1))).withColumn("rid", F.monotonically_increasing_id()), "lm-scored")
    rare = scored.select("rid", F.explode("rare").alias("x")).select("rid", F.col("x.key").alias("key"), F.col("x.n").alias("n"))
    met = rare.join(word_counts.select("key", "c"), "key", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    rest = F.when(F.col("c") > 0, F.log10("c") + F.lit(float(np.log10((1 - unseen) / max(unknown, 1))))).otherwise(F.lit(float(np.log10(unseen))))
    more = met.groupBy("rid").agg(F.sum(F.col("n") * F.log10((F.col("c") + 1) / F.lit(float(total + kinds + 1)))).alias("more"),
                                  F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("known"), F.sum(F.col("n") * rest).alias("rest"))
    out = scored.join(more, "rid", "left")
    return out.select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).cast("long").alias("n_known"),
                      F.lit(total).cast("long").alias("train_tokens"), (F.col("base_score") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
                      (F.col("score") + F.coalesce("rest", F.lit(0.0))).alias("score"))


def gathered(batches: Iterable[pa.RecordBatch], rows: int = 10_000, size: int = 32 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive batches joined up to ``rows`` rows or ``size`` bytes, so that the lanes
    are full in a session whose batches are small, too; one that has as many passes as it is."""
    for full in _groups(batches, rows, size):
        yield full[0] if len(full) == 1 else pa.Table.from_batches(full).combine_chunks().to_batches()[0]


def _groups(batches: Iterable[pa.RecordBatch], rows: int, size: int) -> Iterator[list[pa.RecordBatch]]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= rows or sum(b.nbytes for b in held) >= size:
            yield held
            held = []
    if held:
        yield held


def _scored(rows: DataFrame, vocabulary: Vocabulary, network: Network, head_hash: np.ndarray, head_count: np.ndarray, n_docs: int, denominator: int, share: float) -> DataFrame:
    order = np.argsort(head_hash)
    shared = rows.sparkSession.sparkContext.broadcast(
        (vocabulary.by_frequency, network.size, network.p, head_hash[order], head_count[order]))

    def run(batches):
        words, size, params, known, count = shared.value
        v, net = Vocabulary(words), Network(size, params=params)
        worth = np.log10((count + 1) / denominator)
        end = np.log10((n_docs + 1) / denominator)
        place = np.concatenate([np.zeros(2, np.int64), np.searchsorted(known, words)])  # of ids, in ``known``
        for batch in gathered(batches):
            docs, other, base, seen, rare = [], [], [], [], []
            for _, _, w in word_slices(batch.column(2), fold=LOWER):
                ids, doc = v.ids(w.hash), w.doc()
                at, frequent = place[ids], ids > 0
                out = np.flatnonzero(~frequent)  # of the vocabulary
                if len(known):
                    at[out] = np.minimum(np.searchsorted(known, w.hash[out]), len(known) - 1)
                    frequent[out] = known[at[out]] == w.hash[out]
                base.append(np.bincount(doc[frequent], worth[at[frequent]], minlength=w.n) + end)
                seen.append(np.bincount(doc[frequent], minlength=w.n) + (n_docs > 0))
                new = frequent & (ids == 0)
                other.append(np.bincount(doc[new], np.log10(count[at[new]]) + share, minlength=w.n))
                key, where = w.hash[~frequent], np.searchsorted(doc[~frequent], np.arange(w.n + 1))
                for i in range(w.n):
                    docs.append(ids[w.first[i] : w.first[i + 1]])
                    rare.append(np.unique(key[where[i] : where[i + 1]], return_counts=True))
            score = net.document_scores(docs) / np.log(10) + np.concatenate(other)
            ends = np.concatenate([[0], np.cumsum([len(k) for k, _ in rare])]).astype(np.int32)
            key, n = (np.concatenate([x[i] for x in rare]) for i in range(2))
            items = pa.StructArray.from_arrays([pa.array(key.view(np.int64)), pa.array(n.astype(np.int32))], ["key", "n"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(d) + 1 for d in docs], pa.int64()), pa.array(np.concatenate(seen).astype(np.int64)),
                 pa.array(np.concatenate(base).astype(float)), pa.array(score.astype(float)), pa.ListArray.from_arrays(ends, items)],
                ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "rare"])

    texts = rows.select("doc_id", "held_out", F.col("text").cast("string"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(run, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double, rare array<struct<key:long,n:int>>")


def document_scores(documents: DataFrame) -> DataFrame:
    """Scores by a model learned from documents whose crc32 modulo 7 isn't 2."""
    return scores(documents, fold_of("doc_id", 7) == 2)
