"""Text functions as Columns, inside generated code wherever they can be."""

from __future__ import annotations

import difflib

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# Letters with accents and what they are without.
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUY"


def slug(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def plain_title(c: Column) -> Column:
    """Accents off, signs to spaces, spaces single, lower case."""
    bare = F.regexp_replace(F.lower(F.translate(c, ACCENTED, PLAIN)), r"[^\p{L}\p{N}\s]", " ")
    return F.trim(F.regexp_replace(bare, r"\s+", " "))


def tokens(c: Column, at: str = "[,;]") -> Column:
    """The set of trimmed lower-case parts, in order of first sight, without empty ones."""
    parts = F.transform(F.split(F.lower(c), at), lambda x: F.trim(x))
    return F.array_distinct(F.filter(parts, lambda x: x != ""))


def snippet(column: str, word: str, around: int) -> Column:
    """Up to `around` characters before and after the first place of a word in a column."""
    w = word.replace("'", "''")
    at = f"locate('{w}', `{column}`)"
    return F.expr(f"if({at} > 0, substring(`{column}`, greatest({at} - {around}, 1), {at} + length('{w}') + {around} - greatest({at} - {around}, 1)), null)")


def sentences(c: Column) -> Column:
    return F.split(c, r"(?<=[.!?])\s+(?=\p{Lu})")


@F.pandas_udf(DoubleType())
def entropy(texts: pd.Series) -> pd.Series:
    """Shannon entropy of a text's characters in bits, by counting code points; 0 for an empty or null text. Sorting characters row by row in expressions takes some ten times as long."""
    out = np.zeros(len(texts))
    for k, text in enumerate(texts):
        if text:
            points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
            few = int(points.max()) < 1 << 12
            n = np.bincount(points) if few else np.unique(points, return_counts=True)[1]
            n = n[n > 0]
            out[k] = np.log2(len(points)) - (n * np.log2(n)).sum() / len(points)
    return pd.Series(out)


def _runs(sorted_items: Column, zero: Column, each) -> Column:
    """Fold over a sorted array as over runs of equal items; each(total, run length)."""
    start = F.struct(F.lit(None).cast("string").alias("p"), F.lit(0).alias("r"), zero.alias("t"))

    def step(a: Column, x: Column) -> Column:
        same = a["p"].eqNullSafe(x)
        return F.struct(x.alias("p"), F.when(same, a["r"] + 1).otherwise(F.lit(1)).alias("r"), F.when(same, a["t"]).otherwise(each(a["t"], a["r"])).alias("t"))

    return F.aggregate(sorted_items, start, step, lambda a: each(a["t"], a["r"]))


def once(value: Column, body) -> Column:
    """body(value) with value worked out once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def top_gram_ratio(c: Column, n: int = 5) -> Column:
    """Share of the most frequent run of n words among all runs; 0 below n + 1 words. Runs are sorted within the row, so nothing is shuffled."""

    def ratio(words: Column) -> Column:
        grams = F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - n + 1, F.lit(1))), lambda i: F.array_join(F.slice(words, i, n), " "))
        top = _runs(F.array_sort(grams), F.lit(0), lambda t, r: F.greatest(t, r))
        return F.when(F.size(words) > n, top / (F.size(words) - n + 1)).otherwise(F.lit(0.0))

    return once(F.filter(F.split(c, r"\s+"), lambda x: x != ""), ratio)


def symbol_density(c: Column, symbols: str = "\\${}[]_^") -> Column:
    n = F.length(c)
    return F.when(n > 0, (n - F.length(F.translate(c, symbols, ""))) / n).otherwise(F.lit(0.0))


def loops_on_its_start(c: Column, head: int = 80, least: int = 4) -> Column:
    """Whether the first `head` characters occur `least` times or more; texts below twice as many characters don't loop."""
    start = F.substring(c, 1, head)
    times = (F.length(c) - F.length(F.replace(c, start, F.lit("")))) / head
    return (F.length(c) >= 2 * head) & (times >= least)


@F.pandas_udf(DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff and Obershelp's ratio of two texts; Spark has no built-in for it. 0 where either is null."""
    return pd.Series([difflib.SequenceMatcher(None, x, y).ratio() if x is not None and y is not None else 0.0 for x, y in zip(a, b, strict=True)])
