"""Texts put together from a list of words by a row's key, the same in Spark and in SQL. The driver's tables hold no captions or titles of papers; these stand in for them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Picks = Sequence[tuple[int, int]]  # (factor, shift): which word a key picks


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def phrase(key: Column, words: Sequence[str], picks: Picks) -> Column:
    listed = F.array(*[F.lit(w) for w in words])
    return F.concat_ws(" ", *[F.element_at(listed, (F.pmod(key * a + b, F.lit(len(words))) + 1).cast("int")) for a, b in picks])


def phrase_sql(key: str, words: Sequence[str], picks: Picks) -> str:
    listed = "[" + ", ".join(map(quoted, words)) + "]"
    return "concat_ws(' ', " + ", ".join(f"list_extract({listed}, (({key} * {a} + {b}) % {len(words)} + 1)::INT)" for a, b in picks) + ")"


def table_sql(columns: str, rows: Sequence[Sequence[object]]) -> str:
    """A table of values with its place in the list as `ord`."""
    cell = lambda x: quoted(x) if isinstance(x, str) else "NULL" if x is None else str(x)
    return "(VALUES " + ", ".join(f"({k}, " + ", ".join(map(cell, r)) + ")" for k, r in enumerate(rows)) + f") v(ord, {columns})"
