"""The audit of filters against a plain walk through all orders, with chains in small pieces, salted rounds and colliding fingerprints."""

import random
import re
from itertools import permutations

import pytest

from marlstone.llm import filter_audit as A

DOCS, LABELS = "doc_id long, text string, source string, print long, slot int, _ms_bits int", "doc_id long, quality int, toxic int, part string"


def plain(docs, labels):
    """{(part, order, step): numbers}"""
    least = {}
    for d, t, _ in docs:
        if d is not None:
            least[t or ""] = min(least.get(t or "", d), d)
    good, toxic = {d for d, q, _ in labels if q == 1 and d is not None}, {d for d, _, x in labels if x == 1 and d is not None}
    rows = []
    for d, t, s in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": d is not None and d > least[t]}
        rows.append((s or "", {f for f in fails if fails[f]}, d in good, d in toxic))
    out, total = {}, {}
    for part in {r[0] for r in rows}:
        for order in map("".join, permutations("ABCDE")):
            here = [r for r in rows if r[0] == part]
            gone = []
            for step, f in enumerate(order, 1):
                removed = [r for r in here if f in r[1]]
                kept = [r for r in here if f not in r[1]]
                out[part, order, step] = [len(kept), len(removed), sum(f in r[1] for r in gone), sum(r[0] == part and r[1] == {f} for r in rows), sum(r[2] for r in removed), sum(r[3] for r in removed)]
                total[part, f] = total.get((part, f), 0) + len(removed)
                here, gone = kept, gone + removed
    return {(p, o, s): (*v, total[p, o[s - 1]]) for (p, o, s), v in out.items()}


def audited(spark, docs, labels, parts=8):
    df = spark.createDataFrame([(*d, 0, 1, 2) for d in docs], DOCS).repartition(parts)
    rows = A.audit(df, spark.createDataFrame([(*x, "p") for x in labels], LABELS)).collect()
    assert len({(r.part, r.filter_order, r.step) for r in rows}) == len(rows)
    return {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in rows}


def sample(rng, n):
    words = ["ab", "Cd", "EF", "g%", "h", "ij", "kl", "ü"]
    texts = ["".join(rng.choice(words) + rng.choice(" \t \n") for _ in range(rng.choice([3, 60]))) for _ in range(n // 3)]
    texts += [" ".join(f"w{rng.randint(0, 500)}" for _ in range(70)) for _ in range(20)] + ["", None]
    docs = [(rng.choice([k, k, k, 5, None]), rng.choice(texts + texts[:1] * n), rng.choice(["x", "y", "", None])) for k in range(n)]
    labels = [(rng.choice([k, 5, None]), rng.choice([0, 1, None]), rng.choice([0, 1])) for k in range(0, n, 2)]
    return docs, labels


def test_against_a_plain_walk(spark):
    docs, labels = sample(random.Random(3), 300)
    assert audited(spark, docs, labels) == plain(docs, labels)


def test_small_chains_and_salted_rounds(spark, monkeypatch):
    monkeypatch.setattr(A, "CHAINS", 40)
    monkeypatch.setattr(A, "FAN_IN", 3)
    docs, labels = sample(random.Random(8), 200)
    assert audited(spark, docs, labels, 16) == plain(docs, labels)


def test_chains_keep_colliding_texts_apart():
    chains = A.Chains(16)
    told = [*chains.add(7, "a", 1, 5, {"x": 1}), *chains.add(7, "b", 2, 4, {"x": 1}), *chains.add(7, "a", 1, 3, {"y": 1}), *chains.add(7, "a", 1, 3, {"y": 2}), *chains.add(7, "b", 2, 9, {"z": 1})]
    assert told == [(5, "x", 17, 1), (9, "z", 18, 1)]
    assert list(chains.emptied()) == [(7, "a", 1, 3, {"y": 3}), (7, "b", 2, 4, {"x": 1})] and list(chains.emptied()) == []


def test_edges(spark):
    assert audited(spark, [], []) == {}
    long = "Word# " * 300_000
    docs = [(1, long, "a"), (2, long, "a"), (2, long, "b"), (None, long, None), (7, None, None), (8, "", None)]
    got = audited(spark, docs, [(2, 1, 1), (2, 0, 0), (None, 1, 1)])
    assert got == plain(docs, [(2, 1, 1), (2, 0, 0), (None, 1, 1)])
    assert got["b", "EABCD", 1][1] == 1 and got["", "EABCD", 1][1] == 1 and len(got) == 1800


@pytest.mark.parametrize("text, mask", [("", 1), ("a " * 49, 3), ("a " * 50, 2), (" ".join(map(str, range(50))), 0), ("Ab|", 13), (" " * 60, 1)])
def test_text_mask(text, mask):
    assert A.text_mask(text) == mask
