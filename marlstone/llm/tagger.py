"""A character tagger in numpy: two LSTMs, one for each direction, and a linear chain of tags on top.

Training minimises the negative log-likelihood of labelled windows by back-propagation through time with Adam; decoding is Viterbi with the transitions that no
labelling allows ruled out. All arithmetic is on batches of windows of one width.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

HIDDEN = 20
CHARS = 98  # 0: beyond the text, 1..95: printable ASCII, 96: other ASCII, 97: all else


def codes(text: str) -> np.ndarray:
    p = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    out = np.where((p >= 32) & (p < 127), p - 31, np.where(p < 128, 96, 97))
    return out.astype(np.int64)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Weights:
    """For each direction: input table, recurrence, bias; then output weights of both, output bias, transitions, first tags."""

    arrays: list[np.ndarray]

    @classmethod
    def new(cls, tags: int, rng: np.random.Generator, kind=np.float64) -> Weights:
        h, out = HIDDEN, []
        for _ in range(2):
            bias = np.zeros(4 * h)
            bias[h : 2 * h] = 1.0  # forget little at first
            out += [rng.normal(0, 0.3, (CHARS, 4 * h)), rng.normal(0, 1 / np.sqrt(h), (h, 4 * h)), bias]
        out += [rng.normal(0, 0.3, (2 * h, tags)), np.zeros(tags), np.zeros((tags, tags)), np.zeros(tags)]
        return cls([x.astype(kind) for x in out])


def lstm(x: np.ndarray, wx: np.ndarray, wh: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, list]:
    """x: [time, batch] of codes. Returns hidden states [time, batch, HIDDEN] and what the way back needs."""
    steps, n = x.shape
    h = c = np.zeros((n, HIDDEN), wx.dtype)
    out, kept = np.empty((steps, n, HIDDEN), wx.dtype), []
    given = wx[x] + b
    for t in range(steps):
        z = given[t] + h @ wh
        s = sigmoid(z[:, : 3 * HIDDEN])
        i, f, o = s[:, :HIDDEN], s[:, HIDDEN : 2 * HIDDEN], s[:, 2 * HIDDEN :]
        g = np.tanh(z[:, 3 * HIDDEN :])
        before_c, before_h = c, h
        c = f * c + i * g
        tc = np.tanh(c)
        h = o * tc
        out[t] = h
        kept.append((i, f, o, g, tc, before_c, before_h))
    return out, kept


def lstm_back(x, wx, wh, kept, dh_all):
    """Gradients of the input table, recurrence and bias."""
    steps, n = x.shape
    dwx, dwh, db = np.zeros_like(wx), np.zeros_like(wh), np.zeros(wh.shape[1])
    dh_next = dc = np.zeros((n, HIDDEN), wx.dtype)
    dz_all = np.empty((steps, n, 4 * HIDDEN), wx.dtype)
    for t in range(steps - 1, -1, -1):
        i, f, o, g, tc, before_c, before_h = kept[t]
        dh = dh_all[t] + dh_next
        dc = dc + dh * o * (1 - tc * tc)
        dz = np.concatenate([dc * g * i * (1 - i), dc * before_c * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1)
        dz_all[t] = dz
        dwh += before_h.T @ dz
        dh_next, dc = dz @ wh.T, dc * f
    flat = dz_all.reshape(-1, 4 * HIDDEN)
    np.add.at(dwx, x.ravel(), flat)
    return dwx, dwh, flat.sum(axis=0)


def emissions(w: Weights, x: np.ndarray):
    """x: [time, batch]. Scores [time, batch, tag]."""
    a = w.arrays
    forth, kept_f = lstm(x, *a[0:3])
    back, kept_b = lstm(x[::-1], *a[3:6])
    both = np.concatenate([forth, back[::-1]], axis=2)
    return both @ a[6] + a[7], both, kept_f, kept_b


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def chain_gradient(e: np.ndarray, move: np.ndarray, first: np.ndarray, y: np.ndarray):
    """Mean negative log-likelihood and its gradients for scores e and tags y, both [time, batch, ..]."""
    steps, n, _ = e.shape
    alpha, beta = np.empty_like(e), np.zeros_like(e)
    alpha[0] = first + e[0]
    for t in range(1, steps):
        alpha[t] = e[t] + log_sum(alpha[t - 1][:, :, None] + move[None], 1)
    for t in range(steps - 2, -1, -1):
        beta[t] = log_sum(move[None] + (e[t + 1] + beta[t + 1])[:, None, :], 2)
    z = log_sum(alpha[-1], 1)
    de = np.exp(alpha + beta - z[None, :, None])
    pair = alpha[:-1, :, :, None] + move[None, None] + (e[1:] + beta[1:])[:, :, None, :] - z[None, :, None, None]
    dmove = np.exp(pair).sum(axis=(0, 1))
    rows = np.arange(n)
    gold = first[y[0]] + e[np.arange(steps)[:, None], rows[None, :], y].sum(axis=0) + move[y[:-1], y[1:]].sum(axis=0)
    dfirst = de[0].sum(axis=0)
    np.add.at(dfirst, y[0], -1)
    de[np.arange(steps)[:, None], rows[None, :], y] -= 1
    np.add.at(dmove, (y[:-1].ravel(), y[1:].ravel()), -1)
    return (z - gold).mean(), de / n, dmove / n, dfirst / n


def train(windows: np.ndarray, tags: np.ndarray, kinds: int, steps: int, batch: int, rate: float = 0.02, seed: int = 5) -> Weights:
    """windows, tags: [number, width]. Each step takes the next batch of an order shuffled once for each round."""
    rng = np.random.default_rng(seed)
    w = Weights.new(kinds, rng, np.float32)
    mean, square = [np.zeros_like(a) for a in w.arrays], [np.zeros_like(a) for a in w.arrays]
    order: list[int] = []
    for t in range(1, steps + 1):
        if len(order) < batch:
            order = rng.permutation(len(windows)).tolist()
        pick, order = order[:batch], order[batch:]
        x, y = windows[pick].T, tags[pick].T
        e, both, kept_f, kept_b = emissions(w, x)
        a = w.arrays
        _, de, dmove, dfirst = chain_gradient(e, a[8], a[9], y)
        dboth = de @ a[6].T
        grads = [
            *lstm_back(x, a[0], a[1], kept_f, dboth[:, :, :HIDDEN]),
            *lstm_back(x[::-1], a[3], a[4], kept_b, dboth[::-1, :, HIDDEN:]),
            both.reshape(-1, 2 * HIDDEN).T @ de.reshape(-1, kinds), de.sum(axis=(0, 1)), dmove, dfirst,
        ]
        size = np.sqrt(sum(float((g * g).sum()) for g in grads))
        scale, now = min(1.0, 5.0 / (size + 1e-9)), rate * (1 - 0.9 * t / steps)
        for k, g in enumerate(grads):
            g = g * scale
            mean[k] = 0.9 * mean[k] + 0.1 * g
            square[k] = 0.99 * square[k] + 0.01 * g * g
            a[k] -= now * (mean[k] / (1 - 0.9**t)) / (np.sqrt(square[k] / (1 - 0.99**t)) + 1e-8)
    return w


def decode(w: Weights, windows: np.ndarray, allowed: np.ndarray, first: np.ndarray, lean: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """(best tags [number, width], probability of each tag's kind there given the window). allowed[tag before, tag] and first[tag] are 0 or a large negative number;
    lean is added to the score of all tags but 0."""
    e = emissions(w, windows.T)[0]
    e[:, :, 1:] += lean
    move = (w.arrays[8] + allowed).astype(e.dtype)
    steps, n, kinds = e.shape
    best, back = (w.arrays[9] + first + e[0]).astype(e.dtype), np.empty((steps, n, kinds), np.int8)
    alpha, beta = np.empty_like(e), np.zeros_like(e)
    alpha[0] = best
    for t in range(1, steps):
        ways = best[:, :, None] + move[None]
        back[t] = ways.argmax(axis=1)
        best = e[t] + ways.max(axis=1)
        alpha[t] = e[t] + log_sum(alpha[t - 1][:, :, None] + move[None], 1)
    for t in range(steps - 2, -1, -1):
        beta[t] = log_sum(move[None] + (e[t + 1] + beta[t + 1])[:, None, :], 2)
    out = np.empty((steps, n), np.int64)
    out[-1] = best.argmax(axis=1)
    rows = np.arange(n)
    for t in range(steps - 1, 0, -1):
        out[t - 1] = back[t][rows, out[t]]
    each = np.exp(alpha + beta - log_sum(alpha[-1], 1)[None, :, None])
    at = np.arange(steps)[:, None]
    partner = np.where(out == 0, 0, out - 1 + 2 * (out % 2))  # the first and later tags of a kind stand side by side
    sure = each[at, rows[None, :], out] + np.where(out == 0, 0, each[at, rows[None, :], partner])
    return out.T, sure.T
