"""Unigram scores against plain counting; the model's scores against brute-force sums, and against the unigram on held-out text."""

import math
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest

from marlstone.llm import lm_score as L

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows):
    words = {i: WORD.findall((t or "").translate(LOWER)) for i, t in rows}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    counts = Counter(w for i, ws in words.items() if not held[i] for w in ws)
    counts[None] = sum(not h for h in held.values())
    n, v = sum(counts.values()), len([c for c in counts.values() if c])
    out = {}
    for i, ws in words.items():
        ts = [*ws, None]
        out[i] = (held[i], len(ts), sum(counts[t] > 0 for t in ts), n, sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in ts))
    return out


@pytest.mark.parametrize("hot", [L.HOT, 300])
def test_base_scores(spark, sf_dir, monkeypatch, hot):
    monkeypatch.setattr(L, "HOT", hot)
    monkeypatch.setattr(L, "VOCAB", min(L.VOCAB, hot))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = plain([(r.doc_id, r.text) for r in docs.collect()])
    got = {r.doc_id: r for r in L.score(docs).collect()}
    assert len(got) == len(want)
    for i, w in want.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == w[:4]
        assert r.base_score == pytest.approx(w[4], rel=1e-9)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_scores_by_brute_force(spark, sf_dir):
    """Each text's score from the tables, one word at a time, with sums over all classes and all words of a class."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("length(text) < 600").limit(60)
    rows = docs.select("doc_id", "text").union(spark.createDataFrame([(-1, None), (-2, ""), (-3, "nowhere-seen-word The")], "doc_id long, text string"))
    rows = rows.withColumn("held_out", L.is_held_out(rows.doc_id))
    counts, others, model = L.prepared(rows.filter("not held_out").select("text"))
    tokens = Counter(w for r in rows.filter("not held_out").collect() for w in L.tokens_of(r.text))
    number = {w: k + 2 for k, w in enumerate(counts.hot[: L.VOCAB])}
    outside = sum(n for w, n in tokens.items() if w not in number) + sum(w not in number for w in tokens) + 1

    def log_p(before, word):
        h = [sum(float(model.moved[j][b][k]) for j, b in enumerate(before)) for k in range(L.SIZE)] + [1.0]
        dot = lambda row: sum(x * float(y) for x, y in zip(h, row, strict=True))
        c = max(k for k in range(len(model.starts) - 1) if model.starts[k] <= word)
        classes = [dot(r) for r in model.classes]
        words = {w: dot(model.words[w]) for w in range(model.starts[c], model.starts[c + 1])}
        return classes[c] - math.log(sum(map(math.exp, classes))) + words[word] - math.log(sum(map(math.exp, words.values())))

    for r in L.scored(rows, counts, others, model).collect():
        words = L.tokens_of(next(x.text for x in rows.collect() if x.doc_id == r.doc_id))
        line, want = [L.END] * L.CONTEXT + [number.get(w, L.OTHER) for w in words] + [L.END], 0.0
        for k in range(L.CONTEXT, len(line)):
            want += log_p([line[k - j] for j in range(1, L.CONTEXT + 1)], line[k]) / math.log(10)
        want += sum(math.log10((tokens[w] + 1) / outside) for w in words if w not in number)
        assert r.score == pytest.approx(want, rel=1e-4)


def test_normalised_over_the_vocabulary():
    rng = np.random.default_rng(3)
    net = L.Net(rng.integers(1, 500, 300).astype(float))
    model = L.Model.of(net)
    before = np.repeat(rng.integers(0, 300, (5, L.CONTEXT)), 300, axis=0)
    p = np.exp(model.log_probabilities(before, np.tile(np.arange(300), 5))).reshape(5, 300)
    assert np.allclose(p.sum(axis=1), 1, atol=1e-4)
    assert net.starts[0] == 0 and net.starts[-1] == 300 and (np.diff(net.starts) > 0).all()


def test_improbable_words_stay_finite():
    scores = np.array([[0.0, 200.0, 1.0], [0.0, 1.0, 2.0]], np.float32)
    got = L._normalised(scores.copy(), np.array([0, 1]))
    assert np.allclose(got, [-200.0, 1 - np.log(np.exp([0, 1, 2]).sum())], rtol=1e-5)


def test_positions_of_documents():
    before, word = L.positions([np.array([5, 6]), np.array([], int), np.array([7])])
    assert word.tolist() == [5, 6, 0, 0, 7, 0]
    assert before.tolist() == [[0, 0], [5, 0], [6, 5], [0, 0], [0, 0], [7, 0]]


def test_learns_what_follows_what():
    """A language in which the word two before tells the next: better than the unigram by most of what can be had."""
    rng = np.random.default_rng(1)
    line = [0, 1]
    for _ in range(120_000):
        line.append(int((line[-2] * 7 + 3) % 40) if rng.random() < 0.8 else int(rng.integers(0, 40)))
    ids = np.array(line) + 2
    net = L.Net(np.bincount(ids, minlength=42) + 0.5)
    before, word = L.positions([ids[-5000:]])
    start = L.Model.of(net).log_probabilities(before, word).mean()
    trainer = L.Trainer(net, 5)
    for _ in range(3):
        trainer.learn(np.array_split(ids[:-5000], 20))
    after = L.Model.of(net).log_probabilities(before, word).mean()
    best = 0.8 * math.log(0.805) + 0.2 * math.log(0.005)
    assert after > start + 0.6 * (best - start)


def test_edges(spark):
    i = next(i for i in range(9) if zlib.crc32(str(i).encode()) % 7 != 2)
    df = spark.createDataFrame([(None, None, 1), (i, "", 1), (i, "A a b", 1), (i, "A a b", 1)], "doc_id long, text string, token int")
    got = sorted((r.n_tokens, r.n_known, r.train_tokens) for r in L.score(df).collect())
    assert got == [(1, 1, 10), (1, 1, 10), (4, 4, 10), (4, 4, 10)]
    assert L.score(df.limit(0)).count() == 0
    only_held = spark.createDataFrame([(i, "x y") for i in range(40) if zlib.crc32(str(i).encode()) % 7 == 2], "doc_id long, text string")
    assert {(r.n_known, r.train_tokens, r.base_score) for r in L.score(only_held).collect()} == {(0, 0, 0.0)}


def test_scores_are_worked_out_in_bounded_blocks():
    """What is in work at once doesn't grow with positions times words of a class (before, 220 MB here)."""
    rng = np.random.default_rng(6)
    net = L.Net(np.concatenate([[1e9] * 4, np.ones(6000)]))
    model, widest = L.Model.of(net), int(np.diff(net.starts).argmax())
    word = rng.integers(net.starts[widest], net.starts[widest + 1], 12_000)
    before = rng.integers(0, 6004, (12_000, L.CONTEXT))
    assert np.diff(net.starts)[widest] > 1000
    tracemalloc.start()
    got = model.log_probabilities(before, word)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 12e6
    h = np.ones((50, L.SIZE + 1))
    h[:, : L.SIZE] = sum(model.moved[j][before[:50, j]] for j in range(L.CONTEXT))
    words = h @ model.words[net.starts[widest] : net.starts[widest + 1]].T
    classes = h @ model.classes.T
    share = lambda s, k: s[np.arange(len(s)), k] - np.log(np.exp(s).sum(axis=1))
    assert np.allclose(got[:50], share(classes, np.full(50, widest)) + share(words, word[:50] - net.starts[widest]), atol=1e-4)


def test_rows_that_come_several_times_add_their_gradients():
    trainer = L.Trainer(L.Net(np.ones(30)), 3)
    rng = np.random.default_rng(8)
    rows, h, times = rng.integers(0, 30, 60), rng.normal(size=(20, L.SIZE + 1)).astype(np.float32), rng.normal(size=60).astype(np.float32)
    before, squares = trainer.net.words.copy(), trainer.squares[3].copy()
    trainer._add(3, rows, h, times, 3)
    for r in range(30):
        total = sum((times[i] * h[i // 3] for i in range(60) if rows[i] == r), np.zeros(L.SIZE + 1))
        squares[r] += (total**2).mean()
        assert np.allclose(trainer.net.words[r], before[r] + L.RATE * total / np.sqrt(squares[r]), atol=1e-5)
    assert np.allclose(trainer.squares[3], squares, rtol=1e-4) and (trainer.seen[3] == np.bincount(rows, minlength=30)).all()
