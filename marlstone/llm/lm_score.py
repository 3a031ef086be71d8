"""Language-model scores: a log-bilinear neural model trained by noise-contrastive estimation, next to smoothed unigram scores.

The model predicts a word from the CONTEXT words before it: their vectors, each times the matrix of its position, add up to a context vector, whose products with the vectors of word classes
and of words, plus biases, are scores. Classes are runs of the vocabulary in order of frequency; P(word) = P(class) P(word in class), each normalised over all its members by
batched matrix products, so a token costs some 160 products instead of VOCAB. The vocabulary is the VOCAB most frequent words (fewer in small corpora), one stand-in for all others and the end.

Passes over the documents, all whole:

1. Counts of all tokens of the training documents. Each task counts before anything is shuffled.
2. Training. Both factors learn by noise-contrastive estimation with drawn noise, in mini-batches with Adagrad. A common start is learned on the driver from at most WARM_DOCS documents
   and about WARM_TOKENS tokens (longer documents are left to the tasks); then each task goes once over all positions of all its training documents, and the tasks' changes are averaged, each row of a table by how often
   the task has seen it (one round of parameter mixing).
   What the tasks pass on is summed by table and row, at most VOCAB + classes rows of SIZE + 1 numbers each.
3. Scores. Words outside the vocabulary get the stand-in's probability times their own smoothed share among all such words.

Counts of the at most HOT most frequent tokens go to every task (their number is bounded by a threshold on the count); all rarer tokens of a document are joined
with the table of counts, so that every token has its exact count.

Defined cases: null text counts as empty and is one end token; a null doc_id trains and isn't held out; repeated rows count and are scored as often as they
occur; ties in frequency go by the token's bytes; without training documents all counts are 0 and the model is even; an empty table gives no rows; further
columns are left out. The model depends on how rows lie in partitions, as tasks draw their own noise; counts and base_score don't.
"""

from __future__ import annotations

import copy
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import arrow_map, bounded_sample, least_of_most, small_batches, stored

HOT = 250_000
LONGEST_HOT = 64  # bytes of a token that goes to every task
VOCAB, CONTEXT, SIZE = 16_384, 2, 16
CLASS_NOISE, WORD_NOISE = 16, 2  # draws: the first shared by a mini-batch, the others for each position
POOL = 512  # draws that lie ready for each class
BATCH, RATE = 4096, 0.04
WARM_DOCS, WARM_TOKENS, WARM_ROUNDS = 600, 300_000, 3
SCORED = 65_536  # positions scored at once
CELLS = 1 << 18  # scores worked out at once, so that they stay in a core's cache
END, OTHER = 0, 1  # ids; words follow in order of frequency
COUNTED = 250_000  # different tokens a task counts before it passes them on


def tokens_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case; the end isn't listed."""
    return (text or "").encode().lower().split()


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 7 == 2, F.lit(False))


@dataclass
class Counts:
    """What all tasks know: hot tokens in order of frequency with their counts, and the totals."""

    hot: list[bytes]
    count: np.ndarray
    end: int  # training documents
    total: int  # N
    kinds: int  # V

    @property
    def words(self) -> int:
        return min(VOCAB, len(self.hot))

    def frequencies(self) -> np.ndarray:
        """How often each id of the model's vocabulary occurs in training, at least half a time."""
        inside = self.count[: self.words]
        return np.maximum(np.concatenate([[self.end, self.total - self.end - inside.sum()], inside]), 0.5).astype(np.float64)

    @property
    def outside(self) -> float:
        """log10 of what the smoothed counts of words outside the vocabulary are divided by."""
        return float(np.log10(max(1, (self.total - self.end - int(self.count[: self.words].sum())) + (self.kinds - 1 - self.words) + 1)))


def token_counts(training: DataFrame) -> DataFrame:
    """token, n over all rows of training (text)."""

    def run(batches):
        counted: Counter[bytes] = Counter()

        def out():
            got = pa.RecordBatch.from_arrays([pa.array(counted.keys(), pa.binary()), pa.array(counted.values(), pa.int64())], names=["token", "n"])
            counted.clear()
            return got

        for batch in batches:
            for text in batch.column(0).to_pylist():
                counted.update(tokens_of(text))
                if len(counted) > COUNTED:
                    yield out()
        if counted:
            yield out()

    small_batches(training.sparkSession)
    return training.mapInArrow(run, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))


def hot_tokens(counts: DataFrame, ends: int) -> tuple[Counts, DataFrame]:
    """What all tasks get, and the table of the other tokens."""
    short = F.octet_length("token") <= LONGEST_HOT
    sums = counts.agg(F.sum("n").alias("total"), F.count("*").alias("kinds")).first()
    total, kinds = sums.total or 0, sums.kinds
    is_hot = (F.col("n") >= least_of_most(counts, "n", HOT, short)) & short
    got = counts.filter(is_hot).toArrow()
    pairs = sorted(zip(got.column("n").to_pylist(), got.column("token").to_pylist(), strict=True), key=lambda x: (-x[0], x[1]))
    hot = Counts([t for _, t in pairs], np.array([n for n, _ in pairs], np.int64), ends, total + ends, kinds + (ends > 0))
    return hot, counts.filter(~is_hot)


class Net:
    """The tables of the model. vectors: [id, SIZE]; places: [CONTEXT, SIZE, SIZE]; classes: [class, SIZE + 1]; words: [id, SIZE + 1]; the last column is the bias.

    starts: the first id of each class, and the number of ids."""

    NAMES = ("vectors", "places", "classes", "words")

    def __init__(self, frequencies: np.ndarray):
        width = len(frequencies)
        share = np.cumsum(np.sqrt(frequencies))
        wanted = max(1, int(0.75 * np.sqrt(width)))
        cuts = np.searchsorted(share, share[-1] * np.arange(1, wanted) / wanted)
        self.starts = np.unique(np.concatenate([[0], cuts, [width]])).astype(np.int64)
        self.class_of = (np.searchsorted(self.starts, np.arange(width), "right") - 1).astype(np.uint16)
        mass = np.add.reduceat(frequencies, self.starts[:-1])
        self.class_share = mass / mass.sum()
        self.word_share = frequencies / mass[self.class_of]
        rng = np.random.default_rng(7)
        small = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
        self.vectors, self.classes, self.words = small(width, SIZE), small(len(mass), SIZE + 1), small(width, SIZE + 1)
        self.places = (np.eye(SIZE)[None] / np.arange(1, CONTEXT + 1)[:, None, None]).astype(np.float32)
        # the scores begin as the logarithms of the shares
        self.classes[:, SIZE], self.words[:, SIZE] = np.log(self.class_share), np.log(self.word_share)

    def moved(self, since: list[np.ndarray]) -> list[np.ndarray]:
        return [(getattr(self, n) - old).reshape(-1, old.shape[-1]) for n, old in zip(self.NAMES, since, strict=True)]

    def tables(self) -> list[np.ndarray]:
        return [getattr(self, n).copy() for n in self.NAMES]


def positions(ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(words before each position [n, CONTEXT], nearest first; word at it [n]) of documents given by the ids of their words; the end is a position, and stands before the first word."""
    pad = np.zeros(CONTEXT, np.int64)
    line = np.concatenate([x for d in ids for x in (pad, d, pad[:1])])
    lengths = np.array([len(d) + 1 for d in ids])
    begins = np.cumsum(lengths + CONTEXT) - lengths
    at = np.arange(lengths.sum()) + np.repeat(begins - (np.cumsum(lengths) - lengths), lengths)
    return np.stack([line[at - j] for j in range(1, CONTEXT + 1)], axis=1), line[at]


def _rows(table: np.ndarray, at: np.ndarray) -> np.ndarray:
    """table[at], by the quicker way for short rows."""
    return table.take(at, axis=0, mode="clip")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Trainer:
    """Mini-batches of noise-contrastive estimation on a net, with how often each row of its tables was seen."""

    def __init__(self, net: Net, seed: int):
        self.net, self.rng, self.turn = net, np.random.default_rng(seed), 0
        self.squares = [np.full(t.size // t.shape[-1], 1e-3, np.float32) for t in net.tables()]
        self.seen = [np.zeros(len(s)) for s in self.squares]
        self.class_base = np.log(CLASS_NOISE * net.class_share).astype(np.float32)
        self.word_base = np.log(WORD_NOISE * net.word_share).astype(np.float32)
        self.class_sums, self.word_sums = np.cumsum(net.class_share), np.cumsum(net.word_share)

    def _pool(self) -> np.ndarray:
        """POOL words of each class, drawn by their share in it."""
        draws = np.arange(len(self.net.starts) - 1)[:, None] + self.rng.random((len(self.net.starts) - 1, POOL))
        found = np.searchsorted(self.word_sums, draws)
        return np.clip(found, self.net.starts[:-1, None], self.net.starts[1:, None] - 1)

    def _add(self, k: int, rows: np.ndarray, gradients: np.ndarray, times: np.ndarray | None = None, each: int = 1) -> None:
        """Adagrad on rows of table k; gradients of equal rows are summed. The gradient of rows[i] is gradients[i // each], times times[i]."""
        order = np.argsort(rows.astype(np.uint16), kind="stable")
        rows = rows[order]
        first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
        sorted_by_row = _rows(gradients, order // each if each > 1 else order)
        if times is not None:
            sorted_by_row *= times[order][:, None]
        total, rows, n = np.add.reduceat(sorted_by_row, first), rows[first], np.diff(np.append(first, len(rows)))
        squares = self.squares[k][rows] + np.einsum("ij,ij->i", total, total) / np.float32(total.shape[1])
        self.squares[k][rows] = squares
        total *= (np.float32(RATE) / np.sqrt(squares))[:, None]
        table = getattr(self.net, self.net.NAMES[k])
        table[rows] = _rows(table, rows) + total
        self.seen[k][rows] += n

    def step(self, before: np.ndarray, word: np.ndarray) -> None:
        net, n = self.net, len(word)
        if self.turn % 100 == 0:
            self.pool = self._pool()
        self.turn += 1
        each = [_rows(net.vectors, before[:, j]) for j in range(CONTEXT)]
        h = np.ones((n, SIZE + 1), np.float32)
        h[:, :SIZE] = sum(e @ net.places[j] for j, e in enumerate(each))
        of = net.class_of[word]
        # classes: the true one against draws that the batch shares
        drawn = np.minimum(np.searchsorted(self.class_sums, self.rng.random(CLASS_NOISE)), len(net.classes) - 1)
        own = _rows(net.classes, of)
        true = 1 - _sigmoid(np.einsum("nd,nd->n", h, own) - self.class_base[of])
        false = -_sigmoid(h @ net.classes[drawn].T - self.class_base[drawn])
        back = false @ net.classes[drawn]
        back += np.einsum("n,nd->nd", true, own)
        # words: the true one against draws from its class
        rivals = self.pool[of[:, None], self.rng.integers(0, POOL, (n, WORD_NOISE))]
        every = np.concatenate([word[:, None], rivals], axis=1)
        q = _rows(net.words, every)
        pull = -_sigmoid(np.einsum("nkd,nd->nk", q, h) - self.word_base[every])
        pull[:, 0] += 1
        back += np.einsum("nk,nkd->nd", pull, q)
        back = back[:, :SIZE]
        self._add(3, every.ravel(), h, pull.ravel(), 1 + WORD_NOISE)
        self._add(2, np.concatenate([of, drawn]).astype(np.int64), np.concatenate([h, false.T @ h]), np.concatenate([true, np.ones(CLASS_NOISE, np.float32)]))
        pulls = [back @ net.places[j].T for j in range(CONTEXT)]
        for j, e in enumerate(each):
            self._place(j, e.T @ back, n)
        self._add(0, before.T.ravel(), np.concatenate(pulls))

    def _place(self, j: int, gradient: np.ndarray, n: int) -> None:
        rows = np.arange(SIZE) + j * SIZE
        self.squares[1][rows] += (gradient * gradient).mean(axis=1)
        self.net.places[j] += RATE * gradient / np.sqrt(self.squares[1][rows])[:, None]
        self.seen[1][rows] += n

    def learn(self, ids: list[np.ndarray]) -> None:
        before, word = positions(ids)
        for a in range(0, len(word), BATCH):
            self.step(before[a : a + BATCH], word[a : a + BATCH])


@dataclass
class Model:
    """What scoring needs: for each place the vectors times its matrix, and the tables of classes and words."""

    moved: np.ndarray  # [CONTEXT, id, SIZE]
    classes: np.ndarray
    words: np.ndarray
    starts: np.ndarray
    class_of: np.ndarray

    @classmethod
    def of(cls, net: Net) -> Model:
        return cls(np.stack([net.vectors @ net.places[j] for j in range(CONTEXT)]), net.classes, net.words, net.starts, net.class_of)

    def log_probabilities(self, before: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Natural log P(word | words before) of each position."""
        out = np.empty(len(word))
        for a in range(0, len(word), SCORED):
            # in order of class, so that a class's positions are a slice
            of = self.class_of[word[a : a + SCORED]]
            order = np.argsort(of, kind="stable")
            of, w, b = of[order], word[a + order], before[a + order]
            h = np.ones((len(w), SIZE + 1), np.float32)
            h[:, :SIZE] = sum(_rows(self.moved[j], b[:, j]) for j in range(CONTEXT))
            got = _log_shares(h, self.classes, of)
            ends = np.searchsorted(of, np.arange(len(self.starts)))
            for k in np.flatnonzero(np.diff(ends)):
                at, first = slice(ends[k], ends[k + 1]), self.starts[k]
                got[at] += _log_shares(h[at], self.words[first : self.starts[k + 1]], w[at] - first)
            out[a + order] = got
        return out


def _log_shares(h: np.ndarray, members: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Log-probability of the chosen member for each row of h."""
    out, step = np.empty(len(h)), max(1, CELLS // len(members))
    for a in range(0, len(h), step):
        out[a : a + step] = _normalised(h[a : a + step] @ members.T, chosen[a : a + step])
    return out


def _normalised(scores: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Log-probability of the chosen column in each row of scores. Where the sum is too small or too great for a float, scores are taken against the greatest."""
    picked = scores[np.arange(len(scores)), chosen].astype(np.float64)
    with np.errstate(over="ignore"):
        sums = np.exp(scores).sum(axis=1)
    sound = (sums > 1e-30) & (sums < np.inf)
    out = picked - np.log(np.where(sound, sums, 1))
    for k in np.flatnonzero(~sound):
        top = scores[k].max()
        out[k] = picked[k] - top - np.log(np.exp(scores[k] - top).sum())
    return out


def _numbers(hot: list[bytes], words: int) -> dict[bytes, int]:
    return {w: k + 2 for k, w in enumerate(hot[:words])}


def _ids(text: str | None, number: dict[bytes, int]) -> np.ndarray:
    words = tokens_of(text)
    return np.fromiter(map(number.get, words, repeat(OTHER)), np.int64, len(words))


def fit(training: DataFrame, counts: Counts) -> Model:
    net = Net(counts.frequencies())
    if not counts.total:
        return Model.of(net)
    number = _numbers(counts.hot, counts.words)
    warm, size = [], 0
    for r in sorted(bounded_sample(training, WARM_DOCS).collect(), key=lambda r: (r.text or "")):
        ids = _ids(r.text, number)
        if len(ids) > WARM_TOKENS:
            continue
        warm.append(ids)
        size += len(ids)
        if size > WARM_TOKENS:
            break
    start = Trainer(net, 1)
    for _ in range(WARM_ROUNDS if warm else 0):
        for k in range(0, len(warm), 100):
            start.learn(warm[k : k + 100])
    shipped = training.sparkSession.sparkContext.broadcast((net, counts.hot[: counts.words]))
    columns = [f"v{k}" for k in range(SIZE + 1)]

    def run(batches):
        from pyspark import TaskContext

        start, hot = shipped.value
        net, number = copy.deepcopy(start), _numbers(hot, len(hot))
        since, trainer = start.tables(), Trainer(net, 2 + TaskContext.get().partitionId())
        for batch in batches:
            trainer.learn([_ids(t, number) for t in batch.column(0).to_pylist()])
        for k, (moved, seen) in enumerate(zip(net.moved(since), trainer.seen, strict=True)):
            rows = np.flatnonzero(seen)
            if len(rows):
                by = (moved[rows] * seen[rows, None]).astype(np.float32)
                by = np.pad(by, ((0, 0), (0, SIZE + 1 - by.shape[1])))
                cols = [pa.array(np.full(len(rows), k), pa.int32()), pa.array(rows, pa.int32()), pa.array(seen[rows], pa.float64()), *[pa.array(by[:, c]) for c in range(SIZE + 1)]]
                yield pa.RecordBatch.from_arrays(cols, names=["part", "row", "seen", *columns])

    small_batches(training.sparkSession)
    changes = training.mapInArrow(run, ", ".join(["part int, row int, seen double", *[f"{c} float" for c in columns]]))
    got = changes.groupBy("part", "row").agg(F.sum("seen").alias("seen"), *[F.sum(c).alias(c) for c in columns]).toArrow()
    part, row, seen = (got.column(c).to_numpy() for c in ("part", "row", "seen"))
    change = np.stack([got.column(c).to_numpy() for c in columns], axis=1) / seen[:, None]
    for k, name in enumerate(Net.NAMES):
        own, table = part == k, getattr(net, name)
        flat = table.reshape(-1, table.shape[-1])
        flat[row[own]] += change[own, : table.shape[-1]].astype(np.float32)
    return Model.of(net)


DOC = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, logs double, logs_outside double, lm double, n_outside long, rare array<struct<token:binary,n:int>>"


def _first_scores(docs: DataFrame, counts: Counts, model: Model) -> DataFrame:
    shipped = docs.sparkSession.sparkContext.broadcast((counts, model))

    def make() -> Callable:
        counts, model = shipped.value
        number = {w: k for k, w in enumerate(counts.hot)}
        log = np.log10(np.append(counts.count + 1.0, 1.0))  # the last: not hot
        m, end_log = counts.words, float(np.log10(counts.end + 1.0))
        natural = float(np.log(10))
        known_end = int(counts.end > 0)

        def one(batch):
            cols: list[list] = [[] for _ in range(7)]
            ranks, inside = [], []
            for text in batch.column(3).to_pylist():
                words = tokens_of(text)
                ids = np.fromiter(map(number.get, words, repeat(-1)), np.int64, len(words))
                far = (ids < 0) | (ids >= m)
                logs = log[ids]
                rare = Counter(words[k] for k in np.flatnonzero(ids < 0).tolist())
                ranks.append((len(words) + 1, int((ids >= 0).sum()) + known_end, float(logs.sum()) + end_log, float(logs[far].sum()), int(far.sum()), [{"token": t, "n": n} for t, n in rare.items()]))
                inside.append(np.where(far, OTHER, ids + 2))
            each = model.log_probabilities(*positions(inside)) / natural
            lm = np.add.reduceat(each, np.cumsum([0, *(len(x) + 1 for x in inside[:-1])]))
            for (size, known, logs, outside, n, rare), of_text in zip(ranks, lm.tolist(), strict=True):
                for c, v in zip(cols, (size, known, logs, outside, of_text, n, rare), strict=True):
                    c.append(v)
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64(), pa.list_(pa.struct([("token", pa.binary()), ("n", pa.int32())]))]
            arrays = [*[batch.column(k) for k in range(3)], *[pa.array(c, t) for c, t in zip(cols, kinds, strict=True)]]
            return pa.RecordBatch.from_arrays(arrays, names=["row", "doc_id", "held_out", "n_tokens", "n_known", "logs", "logs_outside", "lm", "n_outside", "rare"])

        return one

    return arrow_map(docs, make, DOC)


def prepared(training: DataFrame) -> tuple[Counts, DataFrame, Model]:
    """(what all tasks know, the table of the other tokens' counts, the model) from the texts to learn from."""
    table = stored(token_counts(training), "token-counts")
    counts, others = hot_tokens(table, training.count())
    return counts, others, fit(training, counts)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out: Callable[[Column], Column] = is_held_out) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row of docs."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    rows = rows.withColumn("held_out", held_out(F.col("doc_id")))
    return scored(rows, *prepared(rows.filter("not held_out").select("text")))


def scored(rows: DataFrame, counts: Counts, others: DataFrame, model: Model) -> DataFrame:
    """rows: doc_id, held_out, text."""
    first = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "text")
    first = stored(_first_scores(first, counts, model), "first-scores")
    rare = first.select("row", F.explode("rare").alias("r")).select("row", F.col("r.token").alias("token"), F.col("r.n").alias("times"))
    # a token without a row in the table has count 0 and adds log10(1)
    more = rare.join(others, "token").groupBy("row").agg(F.sum("times").alias("more_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("more"))
    every = float(np.log10(counts.total + counts.kinds + 1.0))
    more_logs = F.coalesce("more", F.lit(0.0))
    return first.drop("rare").join(more, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(counts.total).cast("long").alias("train_tokens"),
        (F.col("logs") + more_logs - F.col("n_tokens") * F.lit(every)).alias("base_score"),
        (F.col("lm") + F.col("logs_outside") + more_logs - F.col("n_outside") * F.lit(counts.outside)).alias("score"),
    )
