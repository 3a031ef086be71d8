"""Fixed forms against plain patterns; gradients against differences; the tagger on examples it has not seen."""

import random
import re

import numpy as np

from marlstone.llm import pii as P
from marlstone.llm import tagger as T


def plain(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((0, *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((1, *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        odd, even = d[-1::-2], d[-2::-2]
        if 13 <= len(d) <= 19 and (sum(map(int, odd)) + sum(sum(map(int, str(2 * int(c)))) for c in even)) % 10 == 0:
            out.append((2, *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((3, *m.span()))
    return out


def test_fixed_forms():
    rng = random.Random(8)
    bits = ["a", "b.c", "@", "@x.de", ".", "1", "255", "256", "4111 1111 1111 1111", "4111111111111111", "+1", " ", "-", "(555)", "555-1234", "é", "٣", "\n", "00012"]
    for _ in range(20000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 14)))
        assert P.fixed_spans(text) == plain(text), text
    assert P.fixed_spans("1" * 300_000 + "@" * 1000 + "a" * 300_000) == []


def test_gradients():
    rng = np.random.default_rng(0)
    w = T.Weights.new(5, rng)
    x, y = rng.integers(0, T.CHARS, (7, 3)), rng.integers(0, 5, (7, 3))

    def loss():
        e = T.emissions(w, x)[0]
        return T.chain_gradient(e, w.arrays[8], w.arrays[9], y)[0]

    e, both, kept_f, kept_b = T.emissions(w, x)
    a = w.arrays
    _, de, dmove, dfirst = T.chain_gradient(e, a[8], a[9], y)
    dboth = de @ a[6].T
    grads = [*T.lstm_back(x, a[0], a[1], kept_f, dboth[:, :, : T.HIDDEN]), *T.lstm_back(x[::-1], a[3], a[4], kept_b, dboth[::-1, :, T.HIDDEN :])]
    grads += [both.reshape(-1, 2 * T.HIDDEN).T @ de.reshape(-1, 5), de.sum(axis=(0, 1)), dmove, dfirst]
    for k, g in enumerate(grads):
        for _ in range(4):
            at = (x[0, 0], rng.integers(0, g.shape[1])) if k in (0, 3) else tuple(rng.integers(0, n) for n in g.shape)
            old = a[k][at]
            a[k][at] = old + 1e-5
            up = loss()
            a[k][at] = old - 1e-5
            down = loss()
            a[k][at] = old
            assert abs((up - down) / 2e-5 - g[at]) < 1e-5


def test_tagger_and_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    weights = P.fit(docs)
    xs, ys = P.examples([r.text for r in docs.limit(200).collect()], 600, seed=99)
    got, sure = T.decode(weights, xs, P.ALLOWED, P.FIRST)
    assert ((sure > -5e-3) & (sure < 1 + 5e-3)).all()
    inside = (ys > 0) & (xs > 0)
    right = (got == ys) & inside
    assert right.sum() / inside.sum() > 0.85 and right.sum() / ((got > 0) & (xs > 0)).sum() > 0.85
    # no trigger, nothing looked for; overlapping windows tell one long span
    text = "word " * 50 + "call (555) 123-4567 now or write jo.smith [at] mail.example.org today " + "word " * 50
    found = P.added_spans([text], [[]], weights)[0]
    assert (3, text.index("(555"), text.index("(555") + 14) in found
    assert P.regions("no such thing here") == []
    rows = {r.doc_id: r for r in P.scan(docs, weights).collect()}
    for r in docs.collect():
        base = P.fixed_spans(r.text)
        assert [rows[r.doc_id][f"n_{k}"] for k in P.KINDS] == [sum(x[0] == k for x in base) for k in range(4)]
        assert {f"{P.KINDS[k]}:{a}:{b}" for k, a, b in base} <= set(rows[r.doc_id].spans.split(","))
    extra = sum(len(set(rows[r.doc_id].spans.split(",")) - {""}) for r in docs.collect()) - sum(len(P.fixed_spans(r.text)) for r in docs.collect())
    print("added on documents:", extra)
    odd = spark.createDataFrame([(1, None, "x"), (1, None, "x"), (2, "", "y"), (None, "a@b.cd", "z")], "doc_id long, text string, spans string")
    assert sorted((r.spans, r.n_email) for r in P.scan(odd, weights).collect()) == [("", 0), ("", 0), ("", 0), ("email:0:6", 1)]
    assert P.scan(odd.limit(0), weights).count() == 0


def test_long_addresses(spark, sf_dir):
    weights = P.fit(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    for written in ("bartholomew.featherstonehaugh (at) example.com", "jo.smith (at) mail.department.university.org", "maximiliana.von.hohenstaufen [at] informatik [dot] universitaet [dot] de"):
        text = "word " * 50 + f"write {written} today " + "word " * 50
        a = text.index(written)
        assert any(lo <= a and a + len(written) <= hi for lo, hi in P.regions(text))
        assert (0, a, a + len(written)) in P.added_spans([text], [[]], weights)[0], written


def test_long_digit_parts():
    long = "0" * 5000 + "1.2.3.4 and " + "9" * 5000 + ".1.1.1 and " + "1." * 9000 + "1"
    found = [long[a:b] for k, a, b in P.fixed_spans(long) if k == 1]
    assert found[0] == "0" * 5000 + "1.2.3.4" and set(found[1:]) == {"1.1.1.1"}


def planted(texts, number, seed):
    """Texts with written-out forms set between words, and where they are."""
    rng = random.Random(seed)
    for _ in range(number):
        words = re.sub(r"[0-9@]+", "", rng.choice(texts)).split(" ")[:400]
        kind, form = P.variant(rng, written=True)
        k = rng.randrange(len(words) + 1)
        left = " ".join(words[:k]) + " "
        yield left + form + " " + " ".join(words[k:]), (kind, len(left), len(left) + len(form))


def test_written_out_forms_in_held_out_documents(spark, sf_dir):
    """The tagger learns from one half of the documents and is tried on the other: forms set in that no pattern finds, and the texts without them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    weights = P.fit(docs.filter("doc_id % 2 = 0"))
    texts = sorted(r.text for r in docs.filter("doc_id % 2 = 1").collect())
    found = right = 0
    cases = list(planted(texts, 600, 123))
    for (text, span), got in zip(cases, P.added_spans([t for t, _ in cases], [P.fixed_spans(t) for t, _ in cases], weights), strict=True):
        found += len(got)
        right += span in got
    alone = sum(map(len, P.added_spans(texts, [P.fixed_spans(t) for t in texts], weights)))
    print(f"recall {right / len(cases):.3f}, precision {right / found:.3f}, added to {len(texts)} texts as they stand: {alone}")
    assert right / len(cases) > 0.85 and right / found > 0.85
    for text, want in (("write to jo dot smith at example dot com today", "jo dot smith at example dot com"), ("call 0049 30 123456 now", "0049 30 123456"), ("the host 10[.]0[.]3[.]7 answers", "10[.]0[.]3[.]7")):
        assert want in [text[a:b] for _, a, b in P.added_spans([text], [[]], weights)[0]], text
