"""Filters as Columns: a filter state folded into one predicate, guarded casts, searches, null tokens."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Texts that stand for a missing value.
NULL_TOKENS = ("", "nan", "none", "null", "unknown")


def all_of(parts: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def any_of(parts: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, parts, F.lit(False))


def guarded_year(year: Column, low: int, high: int) -> Column:
    """Four digits and in range; the cast can't fail."""
    return year.rlike("^[0-9]{4}$") & F.try_to_number(year, F.lit("9999")).between(low, high)


def conjunction(state: dict, columns: dict[str, str]) -> Column:
    """A filter state as a predicate.

    year_min and year_max bound columns["year"]; a list is IN; a positive number is a lower bound; True asks for true;
    False, None, 0 and empty lists ask for nothing.
    """
    parts: list[Column] = []
    if state.get("year_min") or state.get("year_max"):
        parts.append(guarded_year(F.col(columns["year"]), state.get("year_min") or 0, state.get("year_max") or 9999))
    for key, value in state.items():
        if key in ("year_min", "year_max") or not value:
            continue
        c = F.col(columns[key])
        if value is True:
            parts.append(c)
        elif isinstance(value, (list, tuple, set)):
            parts.append(c.isin(*value))
        else:
            parts.append(c >= F.lit(value))
    return all_of(parts)


def matches_any(c: Column, patterns: Sequence[str], guards: Sequence[str] = ()) -> Column:
    """Contains any of the patterns and none of the guards, whatever the case."""
    low = F.lower(c)
    return any_of(low.contains(p.lower()) for p in patterns) & ~any_of(low.contains(g.lower()) for g in guards)


def blank_to_null(c: Column) -> Column:
    t = F.trim(c)
    return F.when(~F.lower(t).isin(*NULL_TOKENS), t)




def selected(rows: DataFrame, state: dict, columns: dict[str, str], bridges: dict[str, tuple[DataFrame, str, str]], key: str) -> DataFrame:
    """The rows that a filter state selects: its own columns by conjunction, and for each key of bridges a semi-join.

    bridges: for a key of the state (table, its column of the rows' key, its column of values); only the table's rows with a wanted value are joined. An empty list asks for nothing."""
    own = {k: v for k, v in state.items() if k not in bridges}
    kept = rows.filter(conjunction(own, columns))
    for name, (table, of, value) in bridges.items():
        if wanted := state.get(name):
            kept = kept.join(table.filter(F.col(value).isin(*wanted)).select(F.col(of).alias("_of")), F.col(key) == F.col("_of"), "left_semi")
    return kept
