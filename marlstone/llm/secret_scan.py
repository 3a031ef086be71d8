"""Secrets in whole texts: one combined deterministic automaton runs all rules in one pass over the bytes.

The automaton gives the ends of matches; each start is found by the reversed rule's automaton, never past the match before.
Matches whose last part is too short are dropped. The base rules are those of the contract; the others add spans.

Defined cases: null text counts as empty; an empty text has no spans and the digest of the empty string; repeated rows give repeated
results; an empty table gives no rows; further columns are left out. Places are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import automaton as A
from .shared import arrow_map

BUFFER = 1 << 22  # bytes scanned at once; a longer text is scanned alone


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    least: int = 1  # bytes of the match from the one that makes it a match: its last part's length
    any_case: bool = False


# The contract's base rules. An access key of 18 characters has 14 after AKIA.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, True),
    Rule("access", r"AKIA[A-Z0-9]+", 14),
    Rule("hex", r"[0-9a-f]+", 16),
)

# Published forms of other secrets.
MORE = (
    Rule("github", r"gh[opsur]_[A-Za-z0-9]+", 20),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 20),
    Rule("pem", r"-----BEGIN ([A-Z]+ )?([A-Z]+ )?PRIVATE KEY-----"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 16),
    Rule("bearer", r"bearer\x20+[A-Za-z0-9+/_.=-]+", 24, True),
)
RULES = BASE + MORE


@lru_cache(maxsize=4)
def compiled(rules: tuple[Rule, ...]) -> tuple[A.Combined, list[A.Machine]]:
    trees = [A.Parser(r.pattern, r.any_case).parse() for r in rules]
    return A.combine([A.searching(t) for t in trees]), [A.anchored(A.reverse(t)) for t in trees]


def spans_of(texts: list[bytes], rules: tuple[Rule, ...], machines: tuple[A.Combined, list[A.Machine]]) -> list[list[tuple[int, int, int]]]:
    """(start, rule number, end) in code points for each text."""
    machine, backward = machines
    data = b"\xff".join(texts) + b"\xff"
    begins = np.cumsum([0, *[len(t) + 1 for t in texts]])
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for r, (first, ends, before) in enumerate(A.matches(machine, data)):
        enough = ends - first >= rules[r].least
        first, ends, before = first[enough], ends[enough], before[enough]
        for end, last, t in zip(ends.tolist(), before.tolist(), (np.searchsorted(begins, first, "right") - 1).tolist(), strict=True):
            begin = int(begins[t])
            start = A.match_start(backward[r], data, end, max(begin, last))
            out[t].append((start - begin, r, end - begin))
    for t, spans in enumerate(out):
        if spans and not (text := texts[t]).isascii():
            chars = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
            out[t] = [(int(chars[s]), r, int(chars[e])) for s, r, e in spans]
        out[t].sort()
    return out


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, base: int = len(BASE), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, a count for each base kind, base_sha256 and all spans as kind:start:end."""
    counts = [f"n_{r.kind}" for r in rules[:base]]
    machines = compiled(rules)

    def make() -> Callable:
        def one(batch):
            texts = [(t or "").encode() for t in batch.column(1).to_pylist()]
            found, held, size = [], [], 0
            for t in texts:
                held.append(t)
                size += len(t)
                if size >= BUFFER:
                    found += spans_of(held, rules, machines)
                    held, size = [], 0
            if held:
                found += spans_of(held, rules, machines)
            say = lambda spans: ",".join(f"{rules[r].kind}:{s}:{e}" for s, r, e in spans)
            cols = [batch.column(0)]
            cols += [pa.array([sum(x[1] == k for x in f) for f in found], pa.int64()) for k in range(base)]
            cols.append(pa.array([hashlib.sha256(say([x for x in f if x[1] < base]).encode()).hexdigest() for f in found], pa.string()))
            cols.append(pa.array([say(f) for f in found], pa.string()))
            return pa.RecordBatch.from_arrays(cols, names=["doc_id", *counts, "base_sha256", "spans"])

        return one

    schema = ", ".join(["doc_id long", *[f"{c} long" for c in counts], "base_sha256 string", "spans string"])
    return arrow_map(docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")), make, schema)
