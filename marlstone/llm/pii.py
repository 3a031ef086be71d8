"""Personal data in whole texts: patterns of fixed form, and a character tagger that adds what they miss.

The tagger (two LSTMs and a chain of tags, trained in numpy) learns from labelled windows: stretches of PIECE characters of at most FIT_DOCS documents with the spans of
the fixed forms as labels, and the same stretches with written-out variants set in (addresses with "at" and "dot" as words, national numbers, numbers with spaces or
brackets between their parts) and with look-alikes that are none (versions, dates, sums, digests, "at" and "dot" in prose).

Every kind holds a digit, an @, a bracketed "at", or a bare "at" with a dotted name after it. Overlapping windows cover all places within MARGIN characters of one of these,
and the whole run of address characters around an @ or "at"; places further off are outside by definition, which saves the tagger most of the text. Each character takes
its tag from the window in whose middle it is nearest, and spans are read off the joined tags of the whole text. A span is added where the probability of its kind, by the
chain's forward and backward sums, is SURE or more on average over its characters. It is widened to the words, and an address to the whole written address, that it cuts. A last check of what
it holds (digits, an "at") follows, and it must not overlap a fixed span.

Defined cases: null text counts as empty; an empty text has no spans and the digest of the empty string; repeated rows give repeated results; overlapping spans of
different fixed kinds all stay; an empty table gives no rows; without documents to learn from the tagger learns from bare examples; further columns are left out.
Places are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tagger
from .shared import arrow_map, bounded_sample

KINDS = ("email", "ip", "card", "phone")
WIDTH, MARGIN = 64, 24
FIT_DOCS, PIECE = 400, 2000
EXAMPLES, STEPS, BATCH = 4800, 300, 64
SURE, LEAN = 0.6, 2.0  # LEAN: how much the log-odds of being inside are raised, as spans are checked once more and misses are not
DECODED = 512  # windows decoded at once

# The contract's patterns, in forms that read each character a bounded number of times.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DOT = r"(?:\.|\s?[\[({]\s?dot\s?[\])}]\s?|\sdot\s)"
NAME = r"[A-Za-z0-9-]+"
AT = re.compile(rf"@|[\[({{]\s?at\s?[\])}}]|(?<=\s)at(?=\s{NAME}{DOT}[A-Za-z])", re.I)
TRIGGER = re.compile(rf"[0-9]|{AT.pattern}", re.I)
AFTER_AT = re.compile(rf"\s?{NAME}(?:{DOT}{NAME})*", re.I)
DOT_BEFORE = re.compile(r"(?:\s?[\[({]\s?dot\s?[\])}]\s?|\sdot\s)$", re.I)
NUMBERS = re.compile(r"[0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    last, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > last and text[begin - 1] in LOCAL:
            begin -= 1
        if begin < at and (m := DOMAIN.match(text, at + 1)):
            yield begin, m.end()
            last = m.end()
        at = text.find("@", max(at + 1, last))


def addresses(text: str) -> Iterator[tuple[int, int]]:
    for m in DOTTED.finditer(text):
        parts, at = m.group().split("."), m.start()
        for k in range(0, len(parts) - 3, 4):
            end = at + sum(map(len, parts[k : k + 4])) + 3
            significant = [p.lstrip("0") or "0" for p in parts[k : k + 4]]  # parts can be of any length
            if all(len(p) <= 3 and int(p) <= 255 for p in significant):
                yield at, end
            at = end + 1


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in CARD.finditer(text):
        d = digits_of(m.group())
        if 13 <= len(d) <= 19 and luhn(d):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in PHONE.finditer(text):
        if 9 <= len(digits_of(m.group())) <= 15:
            yield m.span()


FIXED = (emails, addresses, cards, phones)


def fixed_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end), by kind, then start."""
    return [(k, a, b) for k, find in enumerate(FIXED) for a, b in find(text)]


# --- labelled examples ------------------------------------------------------------------------------------------


def _digits(rng: random.Random, n: int) -> str:
    return "".join(rng.choice("0123456789") for _ in range(n))


def _name(rng: random.Random) -> str:
    return "".join(rng.choice("abcdefghiklmnoprstuvwz") for _ in range(rng.randint(2, 9)))


def _card(rng: random.Random) -> str:
    body = _digits(rng, 15)
    number = next(body + c for c in "0123456789" if luhn(body + c))
    return rng.choice(["", "", " ", "-"]).join(number[k : k + 4] for k in range(0, 16, 4))


def _written(rng: random.Random, address: str) -> str:
    """An address with its @ and dots in words, in one manner throughout."""
    at, dot = rng.choice([(" (at) ", "."), (" [at] ", "."), ("[at]", "."), ("(at)", "."), (" [at] ", " [dot] "), (" (at) ", " (dot) "), (" at ", " dot "), (" at ", " dot "), (" at ", " dot "), (" at ", " dot "), (" AT ", " DOT "), (" at ", ".")])
    user, host = address.split("@")
    return (user.replace(".", dot) if dot == " dot " or rng.random() < 0.5 else user) + at + host.replace(".", dot)


def variant(rng: random.Random, written: bool = False) -> tuple[int, str]:
    """A kind and an example of it: of fixed form, or else (always, if written) of a form that the patterns miss."""
    a, b = _name(rng), _name(rng)
    plain = not written and rng.random() < 0.3
    kind = rng.choices(range(4), (5, 2, 3, 4))[0]  # addresses are written in the most ways
    if kind == 0:
        inner = f"{_name(rng)}{_name(rng)}." if rng.random() < 0.3 else ""
        host = f"{inner}{b}{rng.choice(['', str(rng.randint(1, 9))])}.{rng.choice(['example.com', 'example.org', 'co.uk', 'net', 'de', 'com', 'org', 'io'])}"
        address = f"{rng.choice([a, f'{a}.{b}', f'{a}{rng.randint(1, 99)}', f'{a}.{rng.randint(1, 99)}', f'{a}_{b}'])}@{host}"
        return 0, address if plain else _written(rng, address)
    if kind == 1:
        between = "." if plain else rng.choice(["[.]", "(.)", " . ", " dot ", "[dot]"])
        return 1, between.join(str(rng.randint(0, 255)) for _ in range(4))
    if kind == 2:
        number = digits_of(_card(rng))
        between = rng.choice(["", " ", "-"]) if plain else rng.choice([".", "  ", "/", " - ", "_"])
        return 2, between.join(number[k : k + 4] for k in range(0, 16, 4))
    area, mid, end = _digits(rng, 3), _digits(rng, 3), _digits(rng, 4)
    land = rng.randint(20, 99)
    if plain:
        return 3, rng.choice([f"+1 ({area}) {mid}-{end}", f"+{land} {area} {mid} {end}", f"+{land}-{area}-{mid}{end}"])
    return 3, rng.choice([f"({area}) {mid}-{end}", f"{area}-{mid}-{end}", f"{area}.{mid}.{end}", f"00{land} {_digits(rng, 2)} {_digits(rng, 6)}", f"00{land} {area} {mid} {end}", f"0{area}/{_digits(rng, 6)}", f"0{area} {mid} {end}", f"(0{_digits(rng, 2)}) {_digits(rng, 7)}"])


def look_alike(rng: random.Random) -> str:
    n = rng.randint
    return rng.choice([
        f"{n(1, 9)}.{n(0, 20)}.{n(0, 20)}", f"{n(1990, 2030)}-{n(10, 12)}-{n(10, 28)}", f"{n(1, 28)}/{n(1, 12)}/{n(1990, 2030)}", f"${n(1, 999)},{_digits(rng, 3)}.{_digits(rng, 2)}",
        "".join(rng.choice("0123456789abcdef") for _ in range(40)), _digits(rng, n(1, 6)), f"@{_name(rng)}", f"{n(1, 12)}:{_digits(rng, 2)}", f"ISBN {_digits(rng, 10)}", _digits(rng, n(16, 30)),
        f"{n(300, 999)}.{n(300, 999)}.{n(0, 999)}.{n(300, 999)}", f"{_digits(rng, 9)}", f"#{_digits(rng, 8)}", f"page {n(1, 400)}", f"{n(1990, 2030)} {n(1990, 2030)} {n(1990, 2030)}", f"{n(1, 99)} {n(100, 999)} {n(100, 999)}",
        f"{_name(rng)} at {_name(rng)} and {_name(rng)}", f"{_name(rng)} at {_name(rng)}. {_name(rng).title()}", f"{_name(rng)} dot {_name(rng)}", f"at {n(1, 12)} dot {n(10, 59)}", f"{_name(rng)} [at] {_name(rng)}",
    ])


def tags_of(spans: list[tuple[int, int, int]], n: int) -> np.ndarray:
    """0 outside, 1 + 2k the first character of kind k, 2 + 2k a later one."""
    out = np.zeros(n, np.int64)
    for k, a, b in spans:
        if not out[a:b].any():
            out[a:b] = 2 + 2 * k
            out[a] = 1 + 2 * k
    return out


def examples(texts: list[str], number: int, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Windows of codes and tags [number, WIDTH]: a quarter as they stand, a half with a kind set in, a quarter with a look-alike."""
    rng = random.Random(seed)
    texts = [t for t in texts if t] or ["some words that say nothing of anyone and go on for a while"]
    hot = [(t, m.start()) for t in texts for m in TRIGGER.finditer(t)]
    xs, ys = np.zeros((number, WIDTH), np.int64), np.zeros((number, WIDTH), np.int64)
    for k in range(number):
        if k % 4 == 0 and hot:  # a stretch as it stands, with the fixed forms as labels
            text, at = rng.choice(hot)
            lo = max(0, at - 200)
            piece, spans = text[lo : at + 200], fixed_spans(text[lo : at + 200])
            begin = max(0, at - lo - rng.randrange(WIDTH))
        else:
            text = rng.choice(texts)
            at = rng.randrange(len(text) + 1)
            left, right = text[max(0, at - WIDTH) : at], text[at : at + WIDTH]
            left, right = re.sub(r"[0-9@]+", "", left), re.sub(r"[0-9@]+", "", right)
            kind, put = (None, look_alike(rng)) if k % 4 == 3 else variant(rng)
            left, right = left.rstrip() + rng.choice([" ", " ", ": ", "\n", " ("]), rng.choice([" ", ". ", ", ", "\n", ") "]) + right.lstrip()
            piece = left + put + right
            spans = [(kind, len(left), len(left) + len(put))] if kind is not None else []
            begin = max(0, len(left) - rng.randrange(WIDTH))
        x, y = tagger.codes(piece), tags_of(spans, len(piece))
        cut = x[begin : begin + WIDTH]
        xs[k, : len(cut)], ys[k, : len(cut)] = cut, y[begin : begin + WIDTH]
    return xs, ys


# A later character follows the first or a later one of its kind.
NEVER = -1e6
_tag = np.arange(1 + 2 * len(KINDS))
_later = (_tag > 0) & (_tag % 2 == 0)
ALLOWED = np.where(_later[None, :] & (_tag[:, None] != _tag[None, :]) & (_tag[:, None] != _tag[None, :] - 1), NEVER, 0.0)
FIRST = np.zeros(len(_tag))  # a window may begin within a span


def fit(docs: DataFrame, text_col: str = "text", fit_docs: int = FIT_DOCS) -> tagger.Weights:
    """Weights learned from a stretch of at most PIECE characters of each of at most fit_docs documents, from where the text's hash says: the bound of what the driver gets."""
    text = F.col(f"`{text_col}`")
    begin = F.pmod(F.xxhash64(text), F.greatest(F.length(text) - PIECE, F.lit(0)) + 1).cast("int") + 1
    pieces = docs.select(F.substring(text, begin, F.lit(PIECE)).alias("text")).filter("text rlike '[0-9@]'")
    texts = sorted(r.text for r in bounded_sample(pieces, fit_docs).collect())
    return tagger.train(*examples(texts, EXAMPLES), len(_tag), STEPS, BATCH)


# --- spans of a text --------------------------------------------------------------------------------------------


def reach(text: str, m: re.Match) -> tuple[int, int]:
    """From where to where an address around an @ or "at" can go."""
    a = m.start() - text[max(0, m.start() - 1) : m.start()].isspace()
    begin, k = a, a
    while True:
        while k and text[k - 1] in LOCAL:
            k -= 1
        if k == begin:
            break
        begin = k
        if not (dot := DOT_BEFORE.search(text, max(0, begin - 9), begin)):
            break
        k = dot.start()
        if not (k and text[k - 1] in LOCAL):
            break
    after = AFTER_AT.match(text, m.end())
    return begin if begin < a else m.start(), after.end() if after else m.end()


def regions(text: str) -> list[tuple[int, int]]:
    """Stretches that hold all places within MARGIN characters of a trigger, and addresses that go further with a MARGIN around them."""
    out: list[tuple[int, int]] = []
    for m in TRIGGER.finditer(text):
        a, b = m.start() - MARGIN, m.end() + MARGIN
        if not "0" <= m.group() <= "9":
            begin, end = reach(text, m)
            a, b = begin - MARGIN if begin <= a else a, end + MARGIN if end >= b else b
        a, b = max(0, a), min(len(text), b)
        while out and a <= out[-1][1]:
            before = out.pop()
            a, b = min(a, before[0]), max(b, before[1])
        out.append((a, b))
    return out


def windows_of(text: str) -> list[tuple[int, int, int]]:
    """(start of the window, first and last place + 1 that take their tags from it)."""
    out, step = [], WIDTH // 2
    for a, b in regions(text):
        at = a
        while True:
            last = at + WIDTH >= b
            out.append((at, a if at == a else at + step // 2, b if last else at + step + step // 2))
            if last:
                break
            at += step
    return out


def holds(kind: int, found: str) -> bool:
    """Whether a span has what its kind can't do without: the digits of a number, the at and dot of an address."""
    d = digits_of(found)
    if KINDS[kind] == "email":
        return bool((m := AT.search(found)) and m.start() and re.search(DOT, found[m.end() :], re.I))
    if KINDS[kind] == "ip":
        parts = [p.lstrip("0") or "0" for p in NUMBERS.findall(found)]
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    if KINDS[kind] == "card":
        return 13 <= len(d) <= 19 and luhn(d)
    return 9 <= len(d) <= 15


def _whole(kind: int, text: str, a: int, b: int) -> tuple[int, int]:
    """A span without white space and stops at its ends, widened to the words it cuts; an address to the whole written address."""
    while b > a and text[b - 1] in " \n\t.,;:":
        b -= 1
    while b > a and text[a] in " \n\t.,;:":
        a += 1
    if a == b:
        return a, b
    if KINDS[kind] == "email" and (m := next((m for m in AT.finditer(text, max(0, a - WIDTH), b + WIDTH) if (w := reach(text, m))[0] < b and a < w[1]), None)):
        a, b = reach(text, m)
    low, high = max(0, a - WIDTH), min(len(text), b + WIDTH)
    while a > low and text[a].isalnum() and text[a - 1].isalnum():
        a -= 1
    while b < high and text[b - 1].isalnum() and text[b].isalnum():
        b += 1
    if KINDS[kind] == "phone" and a and text[a - 1] in "(+" and text[a].isdigit():
        a -= 1
    return a, b


def added_spans(texts: list[str], fixed: list[list[tuple[int, int, int]]], weights: tagger.Weights) -> list[list[tuple[int, int, int]]]:
    places = [(k, *w) for k, t in enumerate(texts) for w in windows_of(t)]
    tags: dict[int, list[tuple[int, np.ndarray, np.ndarray]]] = {}
    for a in range(0, len(places), DECODED):
        part = places[a : a + DECODED]
        x = np.zeros((len(part), WIDTH), np.int64)
        for r, (k, at, _, _) in enumerate(part):
            c = tagger.codes(texts[k][at : at + WIDTH])
            x[r, : len(c)] = c
        for (k, at, lo, hi), y, sure in zip(part, *tagger.decode(weights, x, ALLOWED, FIRST, LEAN), strict=True):
            tags.setdefault(k, []).append((lo, y[lo - at : hi - at], sure[lo - at : hi - at]))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for k, parts in tags.items():
        found: list[tuple[int, int, int, float]] = []
        run: list = []  # kind, start and the probabilities of the span that is open
        before = 0

        def close(end: int, run=run, found=found) -> None:
            if run:
                found.append((run[0], run[1], end, sum(run[2]) / len(run[2])))
                run.clear()

        for lo, y, sure in parts:
            if lo != before:
                close(before)
            for at, (t, p) in enumerate(zip(y.tolist(), sure.tolist(), strict=True), lo):
                kind = (t - 1) // 2 if t else None
                if run and (kind != run[0] or t % 2):
                    close(at)
                if t and not run:
                    run.extend((kind, at, []))
                if t:
                    run[2].append(p)
            before = lo + len(y)
        close(before)
        taken = [(a, b) for _, a, b in fixed[k]]
        for kind, a, b, sure in found:
            a, b = _whole(kind, texts[k], a, b)
            if sure >= SURE and b > a and holds(kind, texts[k][a:b]) and not any(a < e and s < b for s, e in taken):
                out[k].append((kind, a, b))
                taken.append((a, b))
    return out


def scan(docs: DataFrame, weights: tagger.Weights | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, counts of the fixed forms by kind, base_sha256, and all spans as kind:start:end."""
    shipped = docs.sparkSession.sparkContext.broadcast(weights or fit(docs, text_col))

    def make() -> Callable:
        def one(batch):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            some = [k for k, t in enumerate(texts) if TRIGGER.search(t)]
            fixed: list[list[tuple[int, int, int]]] = [[] for _ in texts]
            spans: list[list[tuple[int, int, int]]] = [[] for _ in texts]
            for k in some:
                fixed[k] = fixed_spans(texts[k])
            more = added_spans([texts[k] for k in some], [fixed[k] for k in some], shipped.value)
            for k, extra in zip(some, more, strict=True):
                spans[k] = sorted(fixed[k] + extra)
            say = lambda s: ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in s)
            cols = [batch.column(0), *[pa.array([sum(x[0] == k for x in f) for f in fixed], pa.int64()) for k in range(len(KINDS))]]
            cols += [pa.array([hashlib.sha256(say(f).encode()).hexdigest() for f in fixed], pa.string()), pa.array([say(s) for s in spans], pa.string())]
            return pa.RecordBatch.from_arrays(cols, names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])

        return one

    schema = ", ".join(["doc_id long", *[f"n_{k} long" for k in KINDS], "base_sha256 string", "spans string"])
    return arrow_map(docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")), make, schema)
