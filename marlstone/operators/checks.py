"""Checks of extracted values against their texts, of coordinates, and of how names are used in a text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rules import matches

MOST_SENT = 100_000  # rows of a table of names that are sent to all tasks

# Cues that a name is used in the work at hand, and cues that it is only spoken of.
USED = (
    "used", "applied", "we used", "this study uses", "data used", "method used", "we applied", "this paper uses", "using", "was applied", "is applied", "are used", "were used", "we employ", "employed",
    "we adopt", "adopted", "we utilize", "utilized", "acquired", "acquire", "acquiring", "obtained", "obtain", "downloaded", "download", "retrieved", "retrieve", "collected", "collect", "sourced from",
    "provided by", "incorporate", "incorporated", "leverage", "leveraged",
)
SPOKEN_OF = ("previous studies", "other studies", "review", "for example", "such as", "e.g.", "et al", "proposed by", "introduced by", "according to", "in contrast to")

# What a percentage is by the last keyword before it, and what stands in the way in the same sentence.
PERCENT_RULES = (
    ("OA", "metric.oa", r"overall accura(?:cy|cies)\b|global accuracy\b|classification accuracy\b|\boa\b", None),
    ("F1", "metric.f1", r"\bf1[\s\-]?score\b|\bf1\b", r"commission|omission\s+error"),
    ("IoU", "metric.iou", r"\biou\b|intersection over union", None),
    ("Kappa", "metric.kappa", r"\bkappa\b", None),
    ("Precision", "metric.precision", r"user.?s?\s+accuracy", None),
    ("Recall", "metric.recall", r"producer.?s?\s+accuracy", None),
)
PERCENT = r"\d+(?:\.\d+)?\s*%"


def forms_of(value: Column) -> Column:
    """How a number may be written: with four, three or two places, or a hundred times it with two, one or none; without zeros at the end."""
    written = [F.format_string("%.4f", value), F.format_string("%.3f", value), F.format_string("%.2f", value), F.format_string("%.2f", value * 100), F.format_string("%.1f", value * 100), F.format_string("%.0f", value * 100)]
    bare = F.transform(F.array(*written), lambda x: F.regexp_replace(F.regexp_replace(x, "0+$", ""), r"\.$", ""))
    return F.array_distinct(F.filter(bare, lambda x: x != ""))


def literal_in(value: Column, text: Column) -> Column:
    """Whether a number stands in a text in one of its forms, with no digit beside it."""
    return F.exists(forms_of(value), lambda x: F.regexp_like(text, F.concat(F.lit(r"(?<!\d)"), F.replace(x, F.lit("."), F.lit(r"\.")), F.lit(r"(?!\d)"))))


def box_issues(elements: DataFrame) -> DataFrame:
    """elements: element, text, boxes (array of page, x, y, w, h; null if none). One row for each issue: element, code, detail."""
    has = F.col("boxes").isNotNull()
    box = elements.filter(has).select("element", F.explode("boxes").alias("b")).select("element", "b.*")
    issue = lambda rows, code, detail: rows.select("element", F.lit(code).alias("code"), detail.alias("detail"))
    found = issue(box.filter("page < 1"), "NEGATIVE_PAGE", F.format_string("page=%d", "page"))
    found = found.union(issue(box.filter("w <= 0 or h <= 0"), "ZERO_DIMENSION", F.format_string("w=%.1f h=%.1f", "w", "h")))
    found = found.union(issue(box.filter("x < 0 or y < 0"), "ZERO_POSITION", F.format_string("x=%.1f y=%.1f", "x", "y")))
    pages = F.array_sort(F.array_distinct(F.transform("boxes", lambda b: b["page"])))
    spans = elements.filter(has).select("element", pages.alias("p")).filter("size(p) > 1")
    found = found.union(issue(spans, "MULTI_PAGE_SPAN", F.array_join(F.col("p").cast("array<string>"), ",")))
    return found.union(issue(elements.filter(has & (F.coalesce("text", F.lit("")) == "")), "EMPTY_TEXT_COORDS", F.lit("")))


def sent(table: DataFrame) -> DataFrame:
    """A table of names, sent to all tasks if it is small, counted; a bigger one is dealt out by the join."""
    return F.broadcast(table) if table.limit(MOST_SENT + 1).count() <= MOST_SENT else table


def mentions(texts: DataFrame, names: DataFrame, around: int) -> DataFrame:
    """texts: text_id, text; names: name (one word), what. text_id, name, at (character, from 0) and context of each mention: words of the text are joined with the names."""
    low = F.lower("text")
    words = texts.select("text_id", "text", F.explode(F.array_distinct(F.regexp_extract_all(low, F.lit(r"[a-z0-9][a-z0-9\-]*"), F.lit(0)))).alias("word"))
    met = words.join(sent(names.withColumn("word", F.lower("name"))), "word")
    # places of the word as a whole word, by cutting the text at it
    parts = F.split(F.lower("text"), F.concat(F.lit(r"(?<![a-z0-9\-])\Q"), F.col("word"), F.lit(r"\E(?![a-z0-9\-])")))
    ends = F.transform(F.sequence(F.lit(1), F.size("parts") - 1), lambda k: F.aggregate(F.slice("parts", F.lit(1), k), F.lit(0), lambda a, x: a + F.length(x)) + (k - 1) * F.length("word"))
    placed = met.withColumn("parts", parts).filter("size(parts) > 1").select("text_id", "name", "text", "word", F.explode(ends).alias("at"))
    begin = F.greatest(F.col("at") - around, F.lit(0))
    context = F.substring("text", begin + 1, F.col("at") + F.length("word") + around - begin)
    return placed.select("text_id", "name", "at", context.alias("context"))


def _any(c: Column, words: Sequence[str]) -> Column:
    low = F.lower(c)
    return F.exists(F.array(*[F.lit(w) for w in words]), lambda w: low.contains(w))


def really_used(found: DataFrame) -> DataFrame:
    """Of mentions, for each text and name the first with a cue of use and none of being only spoken of."""
    rows = found.filter(_any(F.col("context"), USED) & ~_any(F.col("context"), SPOKEN_OF))
    return rows.groupBy("text_id", "name").agg(F.min(F.struct("at", "context")).alias("b")).select("text_id", "name", "b.at", "b.context")


def sense_of(contexts: DataFrame, senses: DataFrame) -> DataFrame:
    """contexts: text_id, name, context; senses: name, sense, ord, signals, excludes (arrays), fallback. For each context the sense with most signals less excludes, of equals the first; without any the fallback.

    text_id, name, sense, hits."""
    low = F.lower("context")
    count = lambda c: F.size(F.filter(c, lambda w: low.contains(w)))
    scored = contexts.join(sent(senses), "name").withColumn("hits", F.greatest(F.lit(0), count("signals") - count("excludes")))
    best = scored.groupBy("text_id", "name").agg(F.max_by(F.struct("sense", "hits"), F.struct(F.col("hits"), -F.col("ord"))).alias("b"), F.max(F.when(F.col("fallback"), F.col("sense"))).alias("other"))
    return best.select("text_id", "name", F.when(F.col("b.hits") > 0, F.col("b.sense")).otherwise(F.col("other")).alias("sense"), F.col("b.hits").alias("hits"))


def best_contexts(found: DataFrame, cues: Sequence[str], most: int = 10) -> DataFrame:
    """Of a text's first `most` mentions of a name, the context with most cues, of equals the earlier one."""
    order = Window.partitionBy("text_id", "name").orderBy("at")
    few = found.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= most)
    hits = F.size(F.filter(F.array(*[F.lit(c) for c in cues]), lambda c: F.lower("context").contains(c)))
    return few.groupBy("text_id", "name").agg(F.max_by("context", F.struct(hits, -F.col("at"))).alias("context"))


def reclassified(snippet: Column, value: Column) -> Column:
    """What a share told as a percentage is, by the last keyword in the 80 characters before it; null if that isn't clear.

    Not where a percentage stands before the keyword (but at the very start) or between it and the value, nor where an exclusion stands before the keyword in its sentence."""
    percent = F.round(value * 100, 10)
    shown = F.regexp_replace(percent.cast("decimal(20,10)").cast("string"), r"\.?0+$", "")
    at = F.regexp_instr(snippet, F.concat(F.lit(r"\b"), F.replace(shown, F.lit("."), F.lit(r"\.")), F.lit(r"\s*%")))
    before = F.when(at > 0, F.substring(snippet, F.greatest(at - 80, F.lit(1)), F.least(at - 1, F.lit(80))))
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for kind, _, keyword, exclusion in PERCENT_RULES:
        whole = f"(?is)^(.*)({keyword})(.*)$"
        pre, post = F.regexp_extract(before, whole, 1), F.regexp_extract(before, whole, 3)
        clear = matches(before, keyword) & ~(F.regexp_instr(pre, F.lit(PERCENT)) > 1) & ~matches(post, PERCENT)
        if exclusion:
            between = F.regexp_extract(pre, f"(?is)^.*?(?:{exclusion})(.*)$", 1)
            clear = clear & ~(matches(pre, exclusion) & ~between.contains("."))
        out = out.when(clear, kind)
    return out
