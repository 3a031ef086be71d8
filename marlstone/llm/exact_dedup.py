"""Exact dedup by two passes over Bloom filters, in DataFrame functions only.

Pass one counts, for each slot of a filter of one probe, the rows that set it; the slots that several rows set stay. This filter has many slots for each row and is never held as
bits: it stays dealt out over the cluster by slot, so its size follows the data. Pass two tests each row against a second filter, of the slots that stayed, whose bits are broadcast
in blocks of bounded size (bloom.MAX_SLOTS). A row that fails the test has a text of its own for certain and passes straight through; only the
others are shuffled by digest and grouped exactly.

What is moved: pass one deals out one slot number for each row (8 bytes, counted before the shuffle), never texts; pass two moves rows of repeated texts and at most 5 % of the others.

Defined cases: null text counts as empty; repeated rows of one doc_id and text count as rows of the group and all
carry the same decision; a null doc_id ranks below all others; an empty table gives an empty result; further columns,
whatever their names, pass through `drop_copies` and are left out of `decisions`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bloom
from .shared import fresh, stored


def _digest(text: str, normalise: Callable[[Column], Column]) -> Column:
    return F.unhex(F.sha2(normalise(F.coalesce(F.col(f"`{text}`"), F.lit(""))), 256))


def _passes(docs: DataFrame, id_col: str, text_col: str, normalise: Callable[[Column], Column]) -> tuple[DataFrame, int, bloom.Filter]:
    """(stored rows of doc_id and digest; how many; the filter of the slots that several rows set)."""
    digests = stored(docs.select(F.col(f"`{id_col}`").alias("doc_id"), _digest(text_col, normalise).alias("digest")), "digests")
    rows = digests.count()
    slots = bloom.set_twice(digests.select(bloom.counted_slot(F.col("digest"), rows).alias("slot")), "slot")
    return digests, rows, bloom.Filter(slots, "slot", slots.count())


def _groups(digests: DataFrame, rows: int, repeated: bloom.Filter) -> tuple[DataFrame, DataFrame]:
    """(all rows with the flag maybe; the stored table of digest, keep_id and group_size of those that may be repeated).

    As a table of its own: both sides of a join with it are then dealt out anew, and Spark can split a group that is hot."""
    flagged = repeated.tested(digests, bloom.counted_slot(F.col("digest"), rows), "maybe")
    groups = flagged.filter("maybe").groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    return flagged, stored(groups, "groups")


def decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise: Callable[[Column], Column] = lambda c: c) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256. Texts are read once."""
    flagged, groups = _groups(*_passes(docs, id_col, text_col, normalise))
    alone = flagged.filter("not maybe").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "digest")
    grouped = flagged.filter("maybe").select("doc_id", "digest").join(groups, "digest").select("doc_id", "keep_id", "group_size", "digest")
    return alone.unionByName(grouped).select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise: Callable[[Column], Column] = lambda c: c) -> DataFrame:
    """The rows that stay, with all their columns. Rows the filter shows to be unique aren't shuffled."""
    names = [F.col(f"`{c}`") for c in docs.columns]
    digests, rows, repeated = _passes(docs, id_col, text_col, normalise)
    _, groups = _groups(digests, rows, repeated)
    digest, maybe, of, keep = fresh(docs, "_ms_digest", "_ms_maybe", "_ms_of", "_ms_keep")
    hashed = docs.withColumn(digest, _digest(text_col, normalise))
    tested = repeated.tested(hashed, bloom.counted_slot(F.col(digest), rows), maybe)
    groups = groups.select(F.col("digest").alias(of), F.col("keep_id").alias(keep))
    best = tested.filter(F.col(maybe)).join(groups, (F.col(digest) == F.col(of)) & F.col(f"`{id_col}`").eqNullSafe(F.col(keep)))
    return tested.filter(~F.col(maybe)).select(*names).unionByName(best.select(*names))
