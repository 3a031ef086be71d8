"""Spans of the automaton against regular expressions, on texts made to provoke overlaps, run ends and lane borders."""

import random
import re

import pytest

from marlstone.llm import automaton as A
from marlstone.llm.secret_scan import BASE, RULES, compiled
from marlstone.llm.secret_scan import spans_of as _spans_of

PLAIN = {
    "assign": (re.compile(rb"""(password|passwd|secret|token|api_?key)["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""", re.I), 2, 12),
    "access": (re.compile(rb"AKIA[A-Z0-9]+"), 0, 18),
    "hex": (re.compile(rb"[0-9a-f]+"), 0, 16),
}


def spans_of(texts):
    return _spans_of(texts, RULES, compiled(RULES))


def plain_spans(text):
    out = []
    for k, (kind, (pattern, group, least)) in enumerate(PLAIN.items()):
        for m in pattern.finditer(text.encode()):
            if len(m.group(group)) >= least:
                out.append((len(text.encode()[: m.start()].decode()), k, len(text.encode()[: m.end()].decode())))
    return sorted(out)


PARTS = ["password", "PassWd", "secret", "token", "api_key", "apikey", "api_", "=", ":", " ", '"', "'", "AKIA", "A1B2C3D4E5F6G7", "0123456789abcdef", "abc", "é", "日", "\n", "==", "tok", "eyJ", ".", "-", "x" * 30]


def test_against_plain_patterns():
    rng = random.Random(3)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += ["".join(rng.choice(PARTS) for _ in range(4000)), "a" * 9000, "token=" + "b" * 7000 + " token: x", ""]
    found = spans_of([t.encode() for t in texts])
    for text, spans in zip(texts, found, strict=True):
        assert [x for x in spans if x[1] < len(BASE)] == plain_spans(text), text[:300]


def test_added_kinds():
    texts = ["see ghp_" + "a1B2" * 9 + " end", "-----BEGIN RSA PRIVATE KEY-----", "Bearer " + "q" * 30, "xoxb-1234567890-abcdefghij"]
    kinds = [{RULES[r].kind for _, r, _ in s} for s in spans_of([t.encode() for t in texts])]
    assert "github" in kinds[0] and "pem" in kinds[1] and "bearer" in kinds[2] and "slack" in kinds[3]


def test_open_rules_are_refused():
    with pytest.raises(A.Unsupported):
        A.searching(A.Parser("a(bc)?").parse())


def test_minimal():
    m = A.combine([A.searching(A.Parser("(a|b)c+").parse())])
    assert m.next.shape[0] <= 6


def test_edges(spark):
    from marlstone.llm.secret_scan import scan

    rows = spark.createDataFrame([(1, None, "x"), (1, None, "x"), (2, "", "y"), (None, "token = 0123456789abcdef", "z")], "doc_id long, text string, spans string")
    got = {(r.doc_id, r.spans) for r in scan(rows).collect()}
    assert got == {(1, ""), (2, ""), (None, "assign:0:24,hex:8:24")}
    assert scan(rows.limit(0)).count() == 0
