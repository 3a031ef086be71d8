"""Two parses of the same papers made into one: each field by its own order of precedence, formulas united by what they say, tables of the second only where the first has none."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def plain_formula(c: Column) -> Column:
    """What makes two formulas the same: lower case, no white space."""
    return F.lower(F.regexp_replace(c, r"\s+", ""))


def _united(first: Column, second: Column) -> Column:
    """The formulas of both in order, each once by its plain form; the first one's spelling stays, empty ones go."""
    none = F.array().cast("array<string>")
    every = F.filter(F.concat(F.coalesce(first, none), F.coalesce(second, none)), lambda x: plain_formula(x) != "")
    plain = F.transform(every, plain_formula)
    firsts = F.filter(F.transform(every, lambda x, i: F.when(F.array_position(plain, plain_formula(x)) == i + 1, x)), lambda x: x.isNotNull())
    return firsts


def merged(first: DataFrame, second: DataFrame, key: str, precedence: Mapping[str, str], formulas: str = "formulas", tables: str = "tables") -> DataFrame:
    """key, the fields of precedence, formulas, tables, sources ("first", "second" or "both"). precedence: "first" or "second" for each field: whose value counts where it is neither null nor blank; else the other's.

    Keys are unique in each parse; a null key matches nothing and stays a row of its own."""
    mine, other = first.select(F.struct("*").alias("a"), F.col(key).alias("_ka")), second.select(F.struct("*").alias("b"), F.col(key).alias("_kb"))
    both = mine.join(other, F.col("_ka") == F.col("_kb"), "full")
    given = lambda side, field: F.when(F.trim(F.col(f"{side}.{field}").cast("string")) != "", F.col(f"{side}.{field}"))
    fields = [F.coalesce(*[given(s, f) for s in (("a", "b") if order == "first" else ("b", "a"))]).alias(f) for f, order in precedence.items()]
    kept = F.when(F.coalesce(F.size(f"a.{tables}"), F.lit(0)) > 0, F.col(f"a.{tables}")).otherwise(F.col(f"b.{tables}"))
    sources = F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), "both").when(F.col("a").isNotNull(), "first").otherwise("second")
    return both.select(F.coalesce("_ka", "_kb").alias(key), *fields, _united(F.col(f"a.{formulas}"), F.col(f"b.{formulas}")).alias(formulas), kept.alias(tables), sources.alias("sources"))
