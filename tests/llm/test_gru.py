from __future__ import annotations

import numpy as np

from cardpanel.llm import gru, gru_lm as G, language as L

from .odd import lower, odd_documents, words


def test_small_batches_are_scored_together():
    import pyarrow as pa

    batches = [pa.RecordBatch.from_arrays([pa.array(list(range(a, b)), pa.int64())], ["x"]) for a, b in ((0, 3), (3, 3), (3, 5), (5, 12), (12, 13))]
    got = list(G.gathered(batches, rows=5))
    assert [b.column(0).to_pylist() for b in got] == [[0, 1, 2, 3, 4], [5, 6, 7, 8, 9, 10, 11], [12]]
    assert got[1] is batches[3] and not list(G.gathered([])) and len(list(G.gathered(batches, size=1))) == 4


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in gru.init(5, 3, rng).items()}
    ids, reset = rng.integers(0, 5, (6, 2)), rng.random((6, 2)) < 0.2
    weight = rng.normal(size=(6, 2, 3))

    def loss():
        return float((gru.forward(p, ids, np.zeros((2, 3)), reset)[0] * weight).sum())

    states, cache = gru.forward(p, ids, np.zeros((2, 3)), reset)
    grads = gru.backward(p, ids, cache, weight, reset)
    for k in p:
        for at in [(0, 0), (1, 4), (2, 8)]:
            old = p[k][at]
            p[k][at] = old + 1e-3
            up = loss()
            p[k][at] = old - 1e-3
            down = loss()
            p[k][at] = old
            assert abs((up - down) / 2e-3 - grads[k][at]) < 2e-3, (k, at)


def test_runner_steps_as_forward():
    rng = np.random.default_rng(1)
    p = gru.init(9, 4, rng)
    ids = rng.integers(0, 9, (12, 7))
    want, _ = gru.forward(p, ids, np.zeros((7, 4), np.float32))
    run, h = gru.Runner(p, 7), np.zeros((7, 4), np.float32)
    for t in range(12):
        run.step(ids[t], h)
        assert np.allclose(h, want[t], atol=1e-5)


def test_documents_are_laid_out_whole():
    rng = np.random.default_rng(2)
    docs = [rng.integers(2, 50, n).astype(np.int32) for n in [0, 5, 900, 3, 3, 40, 0, 200]]
    inp, out, owner = G.laid(docs, 99, 4)
    for i, d in enumerate(docs):
        t, lane = np.nonzero(owner == i)
        assert len(set(lane)) == 1 and (np.diff(t) == 1).all()
        assert inp[t, lane].tolist() == [99, *d] and out[t, lane].tolist() == [*d, 1]


def test_class_factored_softmax_sums_to_one_and_scores_do_not_depend_on_lanes(monkeypatch):
    rng = np.random.default_rng(3)
    net = G.Network(23, hidden=5, classes=4)
    net.p["C"] = rng.normal(size=net.p["C"].shape).astype(np.float32)
    h = rng.normal(size=(1, 5)).astype(np.float32)
    total = sum(np.exp(net.log_chances(h, np.array([w])))[0] for w in range(23))
    assert abs(total - 1) < 1e-5
    docs = [rng.integers(0, 23, n).astype(np.int32) for n in [0, 7, 90, 33, 1, 64]]
    want = net.document_scores(docs)
    monkeypatch.setattr(G, "LANES", 1)
    monkeypatch.setattr(G, "WINDOW", 5)
    assert np.allclose(net.document_scores(docs), want, atol=1e-3)
    # one document by hand, state carried throughout
    states, _ = gru.forward(net.p, np.array([[23], *docs[3][:, None]]), np.zeros((1, 5), np.float32))
    assert abs(net.log_chances(states[:, 0], np.append(docs[3], 1)).sum() - want[3]) < 1e-3


def test_softmax_gradients():
    rng = np.random.default_rng(4)
    net = G.Network(11, hidden=3, classes=3)
    for k in "CcWw":
        net.p[k] = rng.normal(size=net.p[k].shape)
    h, ids = rng.normal(size=(8, 3)), rng.integers(0, 11, 8)
    _, dh, grads = net.gradients(h, ids)
    for k, at in (("C", (1, 2)), ("c", (0,)), ("W", (1, 2, 0)), ("w", (2, 1))):
        old, found = net.p[k][at], []
        for e in (1e-5, -1e-5):
            net.p[k][at] = old + e
            found.append(net.gradients(h, ids)[0])
        net.p[k][at] = old
        assert abs((found[0] - found[1]) / 2e-5 - grads[k][at]) < 1e-6
    up, down = h.copy(), h.copy()
    up[2, 1] += 1e-5
    down[2, 1] -= 1e-5
    assert abs((net.gradients(up, ids)[0] - net.gradients(down, ids)[0]) / 2e-5 - dh[2, 1]) < 1e-6


def test_logits_are_made_in_blocks_that_do_not_change_the_result(monkeypatch):
    rng, rows, real = np.random.default_rng(6), [], G.Network._log_chance
    net = G.Network(30, hidden=4, classes=3)
    h, ids = rng.normal(size=(200, 4)).astype(np.float32), rng.integers(0, 30, 200)
    monkeypatch.setattr(G.Network, "_log_chance", staticmethod(lambda x, at, wide: rows.append(len(x)) or real(x, at, wide)))
    found = []
    for block in (1000, 7):
        monkeypatch.setattr(G, "BLOCK", block)
        rows.clear()
        found.append((net.log_chances(h, ids), *net.gradients(h, ids)))
        assert max(rows) <= block and sum(rows) == 4 * len(ids)
    (a, loss, dh, grads), (b, loss_b, dh_b, grads_b) = found
    assert np.allclose(a, b, atol=1e-5) and abs(loss - loss_b) < 1e-5 and np.allclose(dh, dh_b, atol=1e-6)
    assert all(np.allclose(grads[k], grads_b[k], atol=1e-6) for k in grads)


def test_rows_of_rare_and_frequent_symbols_are_added(monkeypatch):
    rng = np.random.default_rng(7)
    for size, n in ((9, 0), (9, 1), (40, 3000), (70_000, 500)):
        at = np.minimum(rng.geometric(0.1, n), size) - 1
        at[: n // 10] = size - 1
        rows, want = rng.normal(size=(n, 6)), np.ones((size, 6))
        got = want.copy()
        np.add.at(want, at, rows)
        for few in (0, 1, G.FEW):
            monkeypatch.setattr(G, "FEW", few)
            table = got.copy()
            G.added(table, at, rows)
            assert np.allclose(table, want)


def test_training_lowers_the_loss():
    rng = np.random.default_rng(5)
    docs = [np.tile(np.array([3, 4, 5, 6], np.int32), 20) for _ in range(40)]
    losses = G.Network(12, hidden=8, classes=3).train(docs, updates=120, lanes=8)
    assert np.mean(losses[-10:]) < 0.3 * np.mean(losses[:5])


def test_training_reads_every_window_of_long_and_short_documents():
    docs = [np.full(2 * G.WINDOW + 5, i, np.int32) for i in range(2, 30)] + [np.array([i], np.int32) for i in range(30, 40)]
    net, start = G.Network(40, hidden=4, classes=4), G.Network(40, hidden=4, classes=4)
    net.train(docs, updates=3, lanes=4)
    assert (net.p["X"][2:] != start.p["X"][2:]).any(1).all()  # words and the start of a text, all were inputs
    docs = [np.arange(n, dtype=np.int32) + 2 for n in (0, 1, 31, 32, 33, 100, 3)]
    got = [list(zip(i[on], o[on], strict=True)) for i, o, _ in G.streamed(docs, 500, 3) for on in [i >= 0]]
    want = [x for d in docs for x in zip([500, *d], [*d, 1], strict=True)]
    assert sorted(x for w in got for x in w) == sorted(want)


def test_windows_of_few_lanes_are_learned_together(monkeypatch):
    shapes, real = [], gru.backward
    monkeypatch.setattr(gru, "backward", lambda p, ids, *rest: shapes.append(ids.copy()) or real(p, ids, *rest))
    rng = np.random.default_rng(8)
    docs = [rng.integers(2, 30, n).astype(np.int32) for n in [*[40] * 30, 41 * G.WINDOW, 3, 0]]
    net, start = G.Network(30, hidden=4, classes=4), G.Network(30, hidden=4, classes=4)
    losses = net.learn(iter(docs), 8, gru.Adam(net.p, G.RATE), 100)
    tokens = sum(len(d) + 1 for d in docs)
    assert len(losses) == len(shapes) <= 2 * tokens / (8 * G.WINDOW) + 1  # not one for each window of the long text
    assert all(s.shape[0] == G.WINDOW and s.shape[1] <= 8 for s in shapes)
    windows = [w[0] for w in G.streamed(iter(docs), 30, 8)]
    assert sum(s.size for s in shapes) == sum(w.size for w in windows) and (np.concatenate(shapes, 1) == np.maximum(np.concatenate(windows, 1), 0)).all()
    # one update over several windows is the sum of the windows' gradients, the state carried on
    ids, out = rng.integers(0, 30, (2 * G.WINDOW, 3)), rng.integers(0, 30, (2 * G.WINDOW, 3))
    h, parts = np.zeros((3, 4), np.float32), []
    for i in range(2):
        states, cache = gru.forward(start.p, ids[i * G.WINDOW : (i + 1) * G.WINDOW], h)
        _, dh, grads = start.gradients(states.reshape(-1, 4), out[i * G.WINDOW : (i + 1) * G.WINDOW].ravel())
        parts.append((states, cache, grads | real(start.p, ids[i * G.WINDOW : (i + 1) * G.WINDOW], cache, dh.reshape(states.shape), None, G.added)))
        h = states[-1]
    beside = lambda x: np.concatenate([x[: G.WINDOW], x[G.WINDOW :]], 1)
    states, cache = np.concatenate([p[0] for p in parts], 1), tuple(np.concatenate([a, b], -2) for a, b in zip(parts[0][1], parts[1][1], strict=True))
    _, dh, grads = start.gradients(states.reshape(-1, 4), beside(out).ravel())
    grads |= real(start.p, beside(ids), cache, dh.reshape(states.shape), None, G.added)
    assert all(np.allclose(g, (parts[0][2][k] + parts[1][2][k]) / 2, atol=1e-6) for k, g in grads.items())


def test_long_texts_are_scored_in_long_windows(monkeypatch):
    rng, rows = np.random.default_rng(9), []
    net, real = G.Network(30, hidden=4, classes=4), G.Network.log_chances
    docs = [rng.integers(2, 30, n).astype(np.int32) for n in (3000, 5, 0, 700, 2900)]
    monkeypatch.setattr(G.Network, "log_chances", lambda self, h, ids, *rest: rows.append(len(ids)) or real(self, h, ids, *rest))
    got = net.document_scores(docs)
    assert sum(rows) == sum(len(d) + 1 for d in docs) and len(rows) <= 3 < max(map(len, docs)) / G.WINDOW
    for d, x in zip(docs, got, strict=True):
        states, _ = gru.forward(net.p, np.array([30, *d])[:, None], np.zeros((1, 4), np.float32))
        assert abs(real(net, states[:, 0], np.append(d, 1)).sum() - x) < 1e-2


def test_counts_do_not_depend_on_how_many_words_are_counted_at_once(spark, monkeypatch):
    docs = spark.createDataFrame([(f"a b a{i % 7} A\tb",) for i in range(300)] + [(None,), ("",)], "text string").repartition(3)
    found = []
    for n in (1 << 21, 50):
        monkeypatch.setattr(G, "AT_ONCE", n)
        found.append(sorted((r.kind, r.key, r.c) for r in G.counts(docs).collect()))
    assert found[0] == found[1] and [c for k, _, c in found[0] if k != G.WORD] == [1500, 302]
    assert sorted(c for k, _, c in found[0] if k == G.WORD) == sorted([600, 600, *[sum(i % 7 == j for i in range(300)) for j in range(7)]])


def test_ids_of_words_whose_hashes_share_their_upper_bits():
    rng = np.random.default_rng(10)
    h = np.unique(rng.integers(0, 1 << 64, 4000, dtype=np.uint64) & np.uint64(0x00FF_0000_0000_FFFF) | np.uint64(7))
    h = rng.permutation(np.append(h, np.uint64(0)))
    words, asked = h[: len(h) // 2], np.concatenate([h, h[::-1], np.zeros(1, np.uint64)])
    want = {int(w): i + 2 for i, w in enumerate(words)}
    assert G.Vocabulary(words).ids(asked).tolist() == [want.get(int(w), 0) for w in asked]
    assert not G.Vocabulary(words[:0]).ids(asked).any() and len(G.Vocabulary(words).ids(asked[:0])) == 0


def test_base_scores_equal_brute_force(spark, monkeypatch):
    import collections
    import math
    import zlib

    monkeypatch.setattr(G, "HEAD", 50)  # most words take the join
    monkeypatch.setattr(G, "VOCABULARY", 20)
    monkeypatch.setattr(G, "UPDATES", 5)
    from cardpanel.llm.tables import read
    docs = read(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").union(odd_documents(spark).select("doc_id", "text").filter("doc_id != 7 or doc_id is null"))
    rows = docs.collect()
    count = collections.Counter()
    train = lambda i: i is None or zlib.crc32(str(i).encode()) % 7 != 2
    for r in rows:
        if train(r.doc_id):
            count.update([*words(lower(r.text)), None])
    n, v = sum(count.values()), len(count)
    want = sorted((str(r.doc_id), len(w) + 1, sum(count[x] > 0 for x in [*w, None]), n, round(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in [*w, None]), 5))
                  for r in rows for w in [words(lower(r.text))])
    got = G.document_scores(docs).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got) == want
    assert all(r.score < 0 and np.isfinite(r.score) for r in got)
    held = [r for r in got if r.held_out]
    assert {str(r.doc_id) for r in held} == {str(r.doc_id) for r in rows if not train(r.doc_id)}


def test_network_learns_from_every_document_and_all_of_long_ones(spark, monkeypatch):
    long = " ".join([*(f"y{i}" for i in range(800)), *["the"] * 1500, *(f"z{i}" for i in range(800))])
    docs = spark.createDataFrame([(i, f"w{i} w{i}") for i in range(2400)] + [(9000, long), (9001, None)], "doc_id long, text string").repartition(4)
    found, real = [], G._scored
    monkeypatch.setattr(G, "_scored", lambda rows, vocabulary, network, *rest: found.append(network) or real(rows, vocabulary, network, *rest))
    for updates, lanes in ((500, 64), (1, 16)):  # one task; eight rounds of several tasks
        monkeypatch.setattr(G, "UPDATES", updates)
        monkeypatch.setattr(G, "TRAIN_LANES", lanes)
        assert G.scores(docs, G.F.lit(False)).filter("score < 0").count() == 2402
        net = found.pop()
        assert net.size == 4003
        assert (net.p["X"][2:] != G.Network(net.size).p["X"][2:]).any(1).all()


def test_scores_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert G.document_scores(docs).count() == 0


def test_languages_on_held_out_rows_and_odd_ones(spark, monkeypatch):
    from cardpanel.llm.tables import read
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    tagger = L.fit(docs, L.fold_of("doc_id", 4) != 2)
    rows = L.predicted(docs, tagger).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.93 * len(rows)
    odd = odd_documents(spark)
    got = L.predicted(odd, tagger).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert {r.lang_pred for r in got if r.doc_id in (4, 5, 6)} == {"und"}
    assert L.predicted(odd.limit(0), tagger).count() == 0
    assert {r.lang_pred for r in L.languages(odd.withColumn("lang", L.F.lit(None).cast("string"))).collect()} == {"und"}


def test_positions_do_not_depend_on_the_batch(monkeypatch):
    tagger = L.Tagger(["a", "b"])
    texts = [b"", b"abc", b"x" * 500, "été".encode() * 60, b" 12 "]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    want = tagger.pooled(data, offsets)
    monkeypatch.setattr(L, "LANES", 3)
    assert np.allclose(tagger.pooled(data, offsets), want, atol=1e-5)
    for i, t in enumerate(texts):
        assert np.allclose(tagger.pooled(np.frombuffer(t, np.uint8), np.array([0, len(t)])), want[i : i + 1], atol=1e-5)
    assert not L.has_letter(b" 12 ") and L.has_letter("é".encode()) and not L.has_letter("→ 1".encode())
