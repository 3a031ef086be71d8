"""Benchmark decontamination by generalised suffix automata of the test items.

An automaton is built over the words of items (ids of words, so a step is one dictionary lookup). Each document's words are streamed through
it, tracking the longest match that ends at each word. Where it is a window's length or more, the window's words are hit; an item
shorter than a window is a window itself, found on the suffix links of the state at hand.

What the driver and a task hold is bounded: items are cut into blocks of at most BLOCK_WORDS words (one longer item is a block of its own), each block's automaton is made
by the driver, put into a file that Spark ships to the executors, and let go before the next. A task holds back texts of about LOT_CHARS characters, streams
them through one automaton after the other, each read from its file when its turn comes, and joins the hits. With one block its automaton stays in memory.

Defined cases: null text has no words; a document without words is not contaminated; null or empty items have no windows; items with the same
text are all counted; rows of one item_id are one item with the windows of all of them; windows of a null item_id hit words but are no item to count; repeated documents are
judged alike; an empty table of documents or items gives no rows or no hits; further columns are left out of `judge` and kept by `clean`.
"""

from __future__ import annotations

import hashlib
import os
import pickle
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import small_batches

WINDOW = 13
COVERAGE = 20  # contaminated if hits are one word in so many, or more
BLOCK_WORDS = 200_000
LOT_CHARS = 16 << 20

# A-Z in lower case; every other ASCII byte that is no digit or letter is a space.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(WORD_BYTES).split()


class SuffixAutomaton:
    """Of several word sequences. For each state: its longest length, suffix link, transitions; and the items whose windows are in the text where it is reached."""

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.word_id: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.item_ids = [i for i, _ in items]
        owners: dict[int, set[int]] = {}
        whole: dict[int, list[bytes]] = {}
        for k, (_, words) in enumerate(items):
            state = 0
            for n, w in enumerate(words, 1):
                state = self._extend(state, self.word_id.setdefault(w, len(self.word_id)))
                if n >= window:
                    owners.setdefault(state, set()).add(k)
            if 0 < len(words) < window:
                whole[k] = words
        self._close(owners, whole)

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:
            q = self.next[last][c]
            return q if self.length[last] + 1 == self.length[q] else self._split(last, c, q)
        new = self._add(self.length[last] + 1, {})
        p = last
        while p != -1 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p == -1:
            self.link[new] = 0
        else:
            q = self.next[p][c]
            self.link[new] = q if self.length[p] + 1 == self.length[q] else self._split(p, c, q)
        return new

    def _add(self, length: int, moves: dict[int, int]) -> int:
        self.next.append(moves)
        self.link.append(0)
        self.length.append(length)
        return len(self.length) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        copy = self._add(self.length[p] + 1, dict(self.next[q]))
        self.link[copy] = self.link[q]
        self.link[q] = copy
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def _close(self, owners: dict[int, set[int]], whole: dict[int, list[bytes]]) -> None:
        """at[s]: the state on s's suffix links that holds the window's length; items[s]: all items in which the words of such a state occur.

        Only states of a window's length or more pass their items on, so that frequent short runs gather no sets. short[s]: (length, state) of
        the short items that end where s does, at most one for each length below the window."""
        n = len(self.length)
        order = sorted(range(n), key=self.length.__getitem__)
        for s in reversed(order):
            up = self.link[s]
            if up > 0 and self.length[up] >= self.window and s in owners:
                owners.setdefault(up, set()).update(owners[s])
        self.at: list[int] = [0] * n
        for s in order:
            if self.length[s] >= self.window:
                self.at[s] = s if self.length[self.link[s]] < self.window else self.at[self.link[s]]
        self.items = {s: tuple(owners.get(s, ())) for s in set(self.at) if s}
        self.short: list[tuple[tuple[int, int], ...]] = [()] * n
        for k, words in whole.items():
            s = 0
            for w in words:
                s = self.next[s][self.word_id[w]]
            if not self.short[s]:
                self.short[s] = ((len(words), s),)
                self.items[s] = ()
            self.items[s] += (k,)
        for s in order[1:]:
            self.short[s] += self.short[self.link[s]]

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """(hit stretches [begin, end) in order, items with windows here)."""
        nxt, link, length, window, at, short = self.next, self.link, self.length, self.window, self.at, self.short
        get, found, stretches = self.word_id.get, set(), []
        state = matched = 0
        for k, c in enumerate(map(get, words)):
            if c is None:
                state = matched = 0
                continue
            while state and c not in nxt[state]:
                state = link[state]
                matched = length[state]
            to = nxt[state].get(c)
            if to is None:
                matched = 0
                continue
            state = to
            matched += 1
            reach = 0
            if matched >= window:
                reach = window
                found.add(at[state])
            for n, holder in short[state]:
                if n <= matched:
                    reach = max(reach, n)
                    found.add(holder)
            if reach:
                begin = k + 1 - reach
                if stretches and begin <= stretches[-1][1]:
                    stretches[-1] = (min(begin, stretches[-1][0]), k + 1)
                    while len(stretches) > 1 and stretches[-2][1] >= stretches[-1][0]:
                        a, b = stretches.pop(), stretches.pop()
                        stretches.append((min(a[0], b[0]), a[1]))
                else:
                    stretches.append((begin, k + 1))
        out: set[int] = set()
        for s in found:
            out.update(self.items[s])
        return stretches, out


def blocks_of(benchmark: DataFrame, id_col: str, text_col: str, window: int, block_words: int) -> Iterator[SuffixAutomaton]:
    """Automata of about block_words words each; the items come to the driver one partition at a time, and one block is held."""
    held, size, any_block = [], 0, False
    for r in benchmark.select(F.col(f"`{id_col}`").cast("string").alias("i"), F.col(f"`{text_col}`").alias("t")).toLocalIterator():
        words = words_of(r.t)
        if not words:
            continue
        if held and size + len(words) > block_words:
            yield SuffixAutomaton(held, window)
            any_block, held, size = True, [], 0
        held.append((r.i, words))
        size += len(words)
    if held or not any_block:
        yield SuffixAutomaton(held, window)


def shipped_blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int, block_words: int) -> list[str]:
    """Names of files, one for each block's automaton, that Spark brings to every executor."""
    names = []
    # below Spark's own folder for files, which goes with the session: executors that come later fetch them from there
    folder = tempfile.mkdtemp(dir=SparkFiles.getRootDirectory())
    for machine in blocks_of(benchmark, id_col, text_col, window, block_words):
        name = f"automaton-{uuid.uuid4().hex}"
        with open(os.path.join(folder, name), "wb") as f:
            pickle.dump(machine, f, pickle.HIGHEST_PROTOCOL)
        benchmark.sparkSession.sparkContext.addFile(os.path.join(folder, name))
        names.append(name)
    return names


def _read(name: str) -> SuffixAutomaton:
    with open(SparkFiles.get(name), "rb") as f:
        return pickle.load(f)


def _covered(stretches: list[list[tuple[int, int]]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for b, e in sorted(x for s in stretches for x in s):
        if out and b <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((b, e))
    return out


Found = tuple[int, list[tuple[int, int]], set]  # words of a text, hit stretches, ids of items


def _matched(docs: DataFrame, where: int, names: list[str], finish: Callable[[pa.RecordBatch, list[Found]], pa.RecordBatch], schema) -> DataFrame:
    """Streams column `where` of docs through all automata; finish makes a batch of results from a batch and what was found in its texts."""
    small_batches(docs.sparkSession)

    def found_in(texts: list[str | None], machines: Iterator[SuffixAutomaton]) -> list[Found]:
        split = list(map(words_of, texts))
        spans: list[list] = [[] for _ in split]
        items: list[set] = [set() for _ in split]
        for machine in machines:
            for k, words in enumerate(split):
                stretches, which = machine.hits(words)
                if stretches:
                    spans[k].append(stretches)
                    items[k].update(machine.item_ids[i] for i in which)
        return [(len(w), s[0] if len(s) == 1 else _covered(s), i) for w, s, i in zip(split, spans, items, strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only = _read(names[0]) if len(names) == 1 else None
        lot: list[pa.RecordBatch] = []
        size = 0

        def done() -> Iterator[pa.RecordBatch]:
            texts = [t for b in lot for t in b.column(where).to_pylist()]
            found = found_in(texts, iter([only]) if only else map(_read, names))
            at = 0
            for b in lot:
                yield finish(b, found[at : at + b.num_rows])
                at += b.num_rows

        for batch in batches:
            if not batch.num_rows:
                continue
            lot.append(batch)
            size += batch.column(where).nbytes
            if only or size >= LOT_CHARS:
                yield from done()
                lot, size = [], 0
        if lot:
            yield from done()

    return docs.mapInArrow(run, schema)


def judge(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", window: int = WINDOW, coverage: int = COVERAGE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated and the hit stretches of words for each row of docs."""

    def finish(batch, found):
        rows = []
        for n, spans, which in found:
            items = sorted(i for i in which if i is not None)
            hit = sum(e - b for b, e in spans)
            sha = hashlib.sha256(",".join(items).encode()).hexdigest()
            rows.append((n, hit, len(items), sha, hit > 0 and coverage * hit >= n, ",".join(f"{b}:{e}" for b, e in spans)))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.string()]
        names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "stretches"]
        return pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]], names=names)

    schema = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, stretches string"
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return _matched(rows, 1, shipped_blocks(benchmark, item_col, text_col, window, block_words), finish, schema)


def cut_out(text: str, stretches: list[tuple[int, int]]) -> str:
    """text without the words of the stretches; what stands between two of its words goes with them."""
    raw = text.encode()
    flat = raw.translate(WORD_BYTES)
    places, k = [], 0
    for w in flat.split():
        k = flat.index(w, k)
        places.append((k, k + len(w)))
        k += len(w)
    out, last = [], 0
    for b, e in stretches:
        out.append(raw[last : places[b][0]])
        last = places[e - 1][1]
    return b"".join([*out, raw[last:]]).decode()


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", window: int = WINDOW, coverage: int = COVERAGE, longest: int | None = None, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents that aren't contaminated, with all their columns. longest: hit stretches of more words are cut out of texts that
    stay; None leaves those texts as they are."""
    where = docs.columns.index(text_col)

    def finish(batch, found):
        keep, texts = [], batch.column(where).to_pylist()
        for k, (n, spans, _) in enumerate(found):
            hit = sum(e - b for b, e in spans)
            keep.append(not (hit and coverage * hit >= n))
            if longest is not None and keep[-1] and (long := [s for s in spans if s[1] - s[0] > longest]):
                texts[k] = cut_out(texts[k], long)
        if longest is not None:
            batch = batch.set_column(where, batch.schema.field(where), pa.array(texts, batch.schema.field(where).type))
        return batch.filter(pa.array(keep, pa.bool_()))

    return _matched(docs, where, shipped_blocks(benchmark, item_col, text_col, window, block_words), finish, docs.schema)
