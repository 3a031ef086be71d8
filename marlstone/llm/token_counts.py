"""Token counts of sections by offset-mapped attribution.

Each document is encoded once and whole. Each token stands for a stretch of the text's bytes; stretches are mapped to code points and joined with the
intervals of the document's sections (both in order, by binary search). A token that lies in one section counts there. One that crosses a boundary
is allocated by the rule asked for:

* "start" (default): to the section that holds the token's first character;
* "end": to the section that holds its last character;
* "majority": to the section that holds most of its characters, the earlier one of equals.

A token that stands for part of a character counts as standing for that character. A token with no section at its place (text between sections) is counted
in the section before it, so that sections' counts always add up to the document's.

Sections are given as a column of arrays of (begin, end) in order without overlap, or made from lines. Fields: `joined_fields` makes one
document of several columns with a section for each.

Defined cases: a null or empty text has one empty section without tokens; repeated rows give repeated results; an empty table gives no rows;
further columns are left out.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bpe
from .shared import arrow_map

RULES = ("start", "end", "majority")
OUT = "doc_id long, section int, char_begin long, char_end long, n_tokens long, n_crossing long, doc_tokens long"


def line_sections(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(begins, ends) of lines, each with its line break."""
    breaks = np.flatnonzero(np.frombuffer(text.encode("utf-32-le"), np.uint32) == 10) + 1
    ends = breaks if len(breaks) and breaks[-1] == len(text) else np.append(breaks, len(text))
    return np.concatenate([[0], ends[:-1]]), ends


def token_spans(text: str, encoder: bpe.Encoder, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, last) character of each token."""
    ids = np.frombuffer(encoder.ids(text), np.uint32)
    if not len(ids):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    ends = np.cumsum(lengths[ids])
    begins = ends - lengths[ids]
    if len(text) == ends[-1]:  # one byte for each character
        return begins, ends - 1
    raw = np.frombuffer(text.encode(), np.uint8)
    char = np.cumsum((raw & 0xC0) != 0x80) - 1
    return char[begins], char[ends - 1]


def attributed(first: np.ndarray, last: np.ndarray, begins: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(section of each token, whether it crosses a boundary); sections begin at begins."""
    a = np.maximum(np.searchsorted(begins, first, "right") - 1, 0)
    b = np.maximum(np.searchsorted(begins, last, "right") - 1, 0)
    crossing = a != b
    if rule == "end":
        return b, crossing
    if rule == "majority" and crossing.any():
        a = a.copy()
        for k in np.flatnonzero(crossing):
            cuts = [first[k], *begins[a[k] + 1 : b[k] + 1], last[k] + 1]
            a[k] += int(np.argmax(np.diff(cuts)))
    return a, crossing


def count(docs: DataFrame, ranks: str | None = None, id_col: str = "doc_id", text_col: str = "text", sections: Column | None = None, rule: str = "start") -> DataFrame:
    """One row per section: doc_id, section, char_begin, char_end, n_tokens, n_crossing, doc_tokens."""
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    given = sections is not None
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), *([sections.alias("sections")] if given else []))

    def make() -> Callable:
        encoder = bpe.encoder(ranks)
        lengths = np.array(encoder.byte_length, np.int64)

        def one(batch):
            cols: list[list] = [[] for _ in range(7)]
            spans = batch.column(2).to_pylist() if given else [None] * batch.num_rows
            for i, text, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), spans, strict=True):
                text = text or ""
                if own:
                    begins, ends = (np.array([list(s.values())[k] for s in own], np.int64) for k in (0, 1))
                else:
                    begins, ends = line_sections(text)
                where, crossing = attributed(*token_spans(text, encoder, lengths), begins, rule)
                n = len(begins)
                counted = np.bincount(where, minlength=n)
                crossed = np.bincount(where[crossing], minlength=n)
                for c, values in zip(cols, ([i] * n, range(n), begins.tolist(), ends.tolist(), counted.tolist(), crossed.tolist(), [len(where)] * n), strict=True):
                    c.extend(values)
            kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 5]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=[x.split()[0] for x in OUT.split(", ")])

        return one

    return arrow_map(rows, make, OUT)


def joined_fields(docs: DataFrame, fields: list[str], between: str = "\n") -> tuple[Column, Column]:
    """(text, sections) of several columns as one document; each field's section takes in the separator after it."""
    parts = [F.coalesce(F.col(f"`{f}`").cast("string"), F.lit("")) for f in fields]
    text = F.concat_ws(between, *parts)
    ends, at = [], F.lit(0)
    for k, p in enumerate(parts):
        begin = at
        at = at + F.length(p) + (len(between) if k < len(parts) - 1 else 0)
        ends.append(F.struct(begin.cast("long").alias("begin"), at.cast("long").alias("end")))
    return text, F.array(*ends)
