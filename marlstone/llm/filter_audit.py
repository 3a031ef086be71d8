"""What each filter of a chain removes, in every order of the filters, from counts of failure masks.

Each document gets a mask with one bit for each filter it fails. Four filters look at the text alone; the fifth fails a text that a row of smaller id has as well, anywhere in the table.

1. Fingerprints (xxhash64 of the whole text). A Bloom filter of the slots that several rows set (bloom.py) tells which texts may occur twice; all others fail the fifth filter for certain not, and
   their texts are never moved.
2. In each task, rows of texts that may be repeated go into collision chains: a fingerprint's chain has an entry for each full text, with its least id. A row above the least id of its entry is a copy, and is
   sent on at once as a few numbers; only the entries themselves are kept, one for each text and task, in at most CHAINS bytes of text before they are passed on.
3. An RDD routes these entries by fingerprint (partitioned by the hash, sorted within partitions with spilling), where chains are closed in the same way: rows above the least id of all entries are copies.
   A text of which a third of all rows are copies comes once from each task. Of more than FAN_IN tasks, entries meet in salted rounds first, so no fingerprint has more than FAN_IN entries in one task.
4. The rows of (id, part, mask) meet the labels by id; combineByKey adds them up to one vector of counts by mask for each part, in each task before anything is shuffled.
5. A part's vector gives all its rows: a product with a fixed 0/1 matrix of (order, step) by mask.

Defined cases: null text counts as empty; a null source is the part ''; a row without id has no smaller id and is no smaller id, but counts; repeated rows of one id and text count as often as they occur and are
not each other's copies; of several labels of an id, any 1 counts; rows without label are neither good nor toxic; an empty table gives no rows; further columns are left out.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from itertools import groupby, permutations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bloom
from .shared import stored, text_or_empty

CHAINS = 64 << 20
FAN_IN = 1024

CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SIGNS = re.compile(rb"[#$%&*|]")

#: name, failure of a text by its bytes, words and code points; bytes.split cuts at \x20 and \x09-\x0D
TEXT_FILTERS: tuple[tuple[str, Callable[[bytes, list[bytes], int], bool]], ...] = (
    ("A", lambda raw, words, points: len(words) < 50),
    ("B", lambda raw, words, points: 100 * len(set(words)) < 65 * len(words)),
    ("C", lambda raw, words, points: 100 * (len(raw) - len(raw.translate(None, CAPITALS))) > 5 * points),
    ("D", lambda raw, words, points: SIGNS.search(raw) is not None),
)
COPY = "E"

ROUTED = "print long, doc_id long, part string, mask int, n long, task int, text string"


def text_mask(text: str, filters: Sequence = TEXT_FILTERS) -> int:
    raw = text.encode()
    words = raw.split()
    return sum(1 << k for k, (_, fails) in enumerate(filters) if fails(raw, words, len(text)))


class Chains:
    """Collision chains: for each fingerprint the different texts, each with its mask, its least id and the rows that have it, by part."""

    def __init__(self, copy_bit: int):
        self.copy, self.chains, self.held = copy_bit, {}, 0

    def add(self, fingerprint: int, text: str, mask: int, doc_id: int, parts: dict[str, int]) -> Iterator[tuple]:
        """Takes one row, or several of equal id; yields (doc_id, part, mask, n) of those now known to be copies."""
        chain = self.chains.setdefault(fingerprint, [])
        entry = next((e for e in chain if e[0] == text), None)
        if entry is None:
            chain.append([text, mask, doc_id, dict(parts)])
            self.held += len(text)
        elif doc_id == entry[2]:
            for part, n in parts.items():
                entry[3][part] = entry[3].get(part, 0) + n
        else:
            above = (doc_id, parts) if doc_id > entry[2] else (entry[2], entry[3])
            if doc_id < entry[2]:
                entry[2:] = [doc_id, dict(parts)]
            for part, n in above[1].items():
                yield above[0], part, mask | self.copy, n

    def emptied(self) -> Iterator[tuple]:
        """(fingerprint, text, mask, least id, parts) of all entries, which are let go."""
        for fingerprint, chain in self.chains.items():
            for entry in chain:
                yield fingerprint, *entry
        self.chains, self.held = {}, 0


def _local(filters: Sequence, most: int) -> Callable:
    def run(number: int, rows: Iterator) -> Iterator[tuple]:
        """Rows of ROUTED: without text where the mask is final."""
        chains = Chains(1 << len(filters))

        def passed_on():
            for fingerprint, text, mask, doc_id, parts in chains.emptied():
                for part, n in parts.items():
                    yield fingerprint, doc_id, part, mask, n, number, text

        for doc_id, part, text, fingerprint, maybe in rows:
            mask = text_mask(text, filters)
            if doc_id is None or not maybe:
                yield fingerprint, doc_id, part, mask, 1, number, None
                continue
            for copy_id, copy_part, copy_mask, n in chains.add(fingerprint, text, mask, doc_id, {part: 1}):
                yield fingerprint, copy_id, copy_part, copy_mask, n, number, None
            if chains.held > most:
                yield from passed_on()
        yield from passed_on()

    return run


def _closed(copy_bit: int, final: bool) -> Callable:
    def run(records: Iterator) -> Iterator[tuple]:
        """Entries sorted by (fingerprint, salt): one group at a time is held, of which each text once."""
        for (fingerprint, salt), group in groupby(records, key=lambda r: r[0]):
            chains = Chains(copy_bit)
            for _, (doc_id, part, mask, n, text) in group:
                for copy_id, copy_part, copy_mask, m in chains.add(fingerprint, text, mask, doc_id, {part: n}):
                    yield fingerprint, copy_id, copy_part, copy_mask, m, salt, None
            for _, text, mask, doc_id, parts in chains.emptied():
                for part, n in parts.items():
                    yield fingerprint, doc_id, part, mask, n, salt, None if final else text

    return run


def masks(docs: DataFrame, filters: Sequence = TEXT_FILTERS, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(doc_id, part, mask, n): how many rows of an id and part have the mask, whose last bit is that of copies; stored."""
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"), text_or_empty(f"`{text_col}`").alias("text"))
    total = rows.count()
    slot = bloom.counted_slot(F.xxhash64("text"), total)
    slots = bloom.set_twice(rows.select(slot.alias("slot")), "slot")
    tested = bloom.Filter(slots, "slot", slots.count()).tested(rows.withColumn("print", F.xxhash64("text")), slot, "maybe")
    tasks = tested.select("doc_id", "part", "text", "print", "maybe").rdd
    local = stored(spark.createDataFrame(tasks.mapPartitionsWithIndex(_local(filters, CHAINS)), ROUTED, verifySchema=False), "audited")
    done, entries, copy_bit = [local.filter("text is null")], local.filter("text is not null"), 1 << len(filters)
    salts, width = -(-tasks.getNumPartitions() // FAN_IN), int(spark.conf.get("spark.sql.shuffle.partitions"))
    while True:
        keyed = entries.rdd.map(lambda r, s=salts: ((r.print, r.task % s), (r.doc_id, r.part, r.mask, r.n, r.text)))
        routed = keyed.repartitionAndSortWithinPartitions(width, lambda key: key[0] + key[1]).mapPartitions(_closed(copy_bit, salts == 1))
        closed = stored(spark.createDataFrame(routed, ROUTED, verifySchema=False), "chains")
        done.append(closed.filter("text is null"))
        if salts == 1:
            break
        entries, salts = closed.filter("text is not null"), -(-salts // FAN_IN)
    final = done[0]
    for more in done[1:]:
        final = final.unionByName(more)
    return final.select("doc_id", "part", "mask", "n")


def mask_counts(judged: DataFrame, labels: DataFrame, filters: int, id_col: str = "doc_id"):
    """RDD of (part, counts by mask: of rows, of good ones, of toxic ones), for masks of so many filters."""
    one = lambda c: F.coalesce(F.max(F.col(c)) == 1, F.lit(False))
    marks = labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("labelled")).agg(one("quality").alias("good"), one("toxic").alias("toxic"))
    rows = judged.groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n")).join(marks, F.col("doc_id") == F.col("labelled"), "left")
    kinds = 1 << filters

    def started(row):
        return added(np.zeros((3, kinds), np.int64), row)

    def added(counts, row):
        mask, n, good, toxic = row
        counts[:, mask] += (n, n if good else 0, n if toxic else 0)
        return counts

    return rows.select("part", "mask", "n", "good", "toxic").rdd.map(lambda r: (r.part, (r.mask, r.n, r.good, r.toxic))).combineByKey(started, added, lambda a, b: a + b)


def _tables(letters: str):
    """For each (order, step): its filter, and which masks are kept, removed there, and removed earlier though they fail it, as 0/1 vectors."""
    all_masks = np.arange(1 << len(letters))
    places, kept, removed, redundant = [], [], [], []
    for order in permutations(range(len(letters))):
        before = 0
        for step, f in enumerate(order, 1):
            fails, gone = (all_masks >> f & 1) == 1, (all_masks & before) != 0
            places.append(("".join(letters[k] for k in order), step, f))
            kept.append(~fails & ~gone)
            removed.append(fails & ~gone)
            redundant.append(fails & gone)
            before |= 1 << f
    return places, *(np.array(m, np.int64) for m in (kept, removed, redundant))


AUDIT = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def audit(docs: DataFrame, labels: DataFrame, filters: Sequence = TEXT_FILTERS, **columns: str) -> DataFrame:
    """One row per part, order and step; see the module's text."""
    letters = "".join(name for name, _ in filters) + COPY
    counts = mask_counts(masks(docs, filters, **columns), labels, len(letters))

    def rows(parts: Iterator) -> Iterator[tuple]:
        places, kept, removed, redundant = _tables(letters)
        of = np.array([f for _, _, f in places])
        for part, (n, good, toxic) in parts:
            here = removed @ n
            shapley = [int(here[of == f].sum()) for f in range(len(letters))]
            numbers = np.stack([kept @ n, here, redundant @ n, n[1 << of], removed @ good, removed @ toxic]).T.tolist()
            for (order, step, f), row in zip(places, numbers):
                yield part, order, step, *row, shapley[f]

    return docs.sparkSession.createDataFrame(counts.mapPartitions(rows), AUDIT, verifySchema=False)
