"""Mixing of sources to target weights by a curriculum that changes over time.

Training time runs from 0 to 1. Each source has a target of words and a schedule: its weight over time, linear between knots. The schedule's integral up to t, over its whole, is the share of the target
that is asked for by then; the inverse of this cumulative demand gives a document its position: the time at which the words that its source gave before it have all been asked for.

1. Sizes are counted at the scan; from then on rows of a few numbers move, never texts.
2. Targets by pouring: every source gets weight times a common level, but at most MOST times its size; the level rises by what the full ones leave until none is above. Sources are a table, ranked by
   a distributed sort; a round is one sum over it, and there are as many as times that sources newly fill up (each round takes all of them).
3. A source's documents stand in the order of a hash of their ids, once, and once more for the second pass. The words before a document are a prefix sum in two levels: a source is cut into slices by the hash, as many
   as the root of the number of rows, so that neither a slice nor the list of a source's slices grows faster than that, however hot the source.
4. A document is taken whole, in each pass whose start lies before the target; the last one of a source is cut at the target, so that a source gives its target to the word.
5. The documents are range-sorted by position.

Defined cases: null text has no words; null sources are one source, ranked last; '' is a source of its own; documents without words take nothing and have no position; repeated rows of an id are documents of their own
(all of them in the order of their sizes); a null id is hashed as '';
sources without words have target 0; an empty table gives no rows; further columns are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored, text_or_empty

WEIGHTS = (5.0, 2.0, 1.0)
SHARE, MOST = 1.5, 2
#: For each weight in turn the knots (time, weight over time): what weighs most comes early, what weighs least late.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (1.0, 1.5)))
SEED = "12:"


def _order(id_col: str) -> Column:
    return F.md5(F.concat(F.lit(SEED), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))


def _slice(order: str, slices: int) -> Column:
    return F.floor(F.conv(F.substring(order, 1, 8), 16, 10).cast("long") * F.lit(slices) / F.lit(1 << 32)).cast("long")


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, size, ord): words of each document; stored."""
    words = F.regexp_count(text_or_empty(f"`{text_col}`"), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").cast("string").alias("source"), words.alias("size"))
    return stored(rows.withColumn("ord", _order("doc_id")), "sizes")


def targets(sized: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, place, weight, target) of each source; place: its number in order of code points, null last. Stored."""
    spark = sized.sparkSession
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size")).orderBy(F.col("source").asc_nulls_last())
    ranked = spark.createDataFrame(sources.rdd.zipWithIndex().map(lambda r: (r[0].source, r[0].source_size, r[1])), "source string, source_size long, place long")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    table = stored(ranked.withColumn("weight", weight), "sources")
    full = lambda level: most * F.col("source_size") < F.lit(level) * F.col("weight")
    total, level = share * (table.agg(F.sum("source_size")).first()[0] or 0), 0.0
    while True:
        held, open_weight = table.agg(F.sum(F.when(full(level), most * F.col("source_size"))), F.sum(F.when(~full(level), F.col("weight")))).first()
        new = (total - (held or 0)) / open_weight if open_weight else level
        if new <= level:
            break
        level = new
    return stored(table.withColumn("target", F.when(full(level), (most * F.col("source_size")).cast("double")).otherwise(F.lit(level) * F.col("weight"))), "targets")


def positions(demand: Column, schedules: Sequence, place: Column) -> Column:
    """The time by which `demand` (0 to 1) of all that a source's schedule asks for is asked for; schedules take turns by place."""
    out = F.lit(None).cast("double")
    for k, knots in enumerate(schedules):
        areas = [(t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:])]
        asked = demand * sum(areas)
        time, before = None, 0.0
        for area, (t0, w0), (t1, w1) in zip(areas, knots, knots[1:]):
            rest, slope = asked - before, (w1 - w0) / (t1 - t0)
            # the root of w0 x + slope x^2 / 2 = rest, in the form that also holds for a slope of 0
            here = t0 + F.coalesce(F.try_divide(2 * rest, w0 + F.sqrt(w0 * w0 + 2 * slope * rest)), F.lit(0.0))
            time = here if time is None else F.when(asked < before, time).otherwise(here)
            before += area
        out = F.when(place % len(schedules) == k, time).otherwise(out)
    return out


def mixed(docs: DataFrame, weights: Sequence[float] = WEIGHTS, schedules: Sequence = SCHEDULES, share: float = SHARE, most: int = MOST, **columns: str) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken, passes (structs of pass, position and words); stored. `most` passes at most."""
    sized = sizes(docs, **columns)
    table = targets(sized, weights, share, most)
    cut = sized.withColumn("slice", _slice("ord", max(1, int(sized.count() ** 0.5))))
    # sums by slice, and the words of all slices before it
    order = Window.partitionBy("source").orderBy("slice")
    sums = cut.groupBy("source", "slice").agg(F.sum("size").alias("held"))
    sums = stored(sums.withColumn("ahead", F.sum("held").over(order) - F.col("held")), "slices")
    of = sums.select(F.col("source").alias("of"), F.col("slice").alias("at"), "ahead")
    facts = of.join(table, F.col("of").eqNullSafe(F.col("source"))).select("of", "at", "ahead", "place", "source_size", "target")
    joined = cut.join(stored(facts, "facts"), cut.source.eqNullSafe(F.col("of")) & (F.col("slice") == F.col("at")))
    within = Window.partitionBy("source", "slice").orderBy("ord", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = joined.withColumn("start", F.col("ahead") + F.sum("size").over(within) - F.col("size"))
    passes = []
    for k in range(most):
        start = F.col("start") + k * F.col("source_size")
        words = F.least(F.col("size"), F.floor("target") - start)
        passes.append(F.when(words > 0, F.struct(F.lit(k).alias("pass"), positions(start / F.col("target"), schedules, F.col("place")).alias("position"), words.alias("words"))))
    placed = placed.withColumn("passes", F.array_compact(F.array(*passes)))
    taken = F.aggregate("passes", F.lit(0).cast("long"), lambda a, p: a + p["words"])
    return stored(placed.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"), "passes"), "mixed")


def training_order(mix: DataFrame) -> DataFrame:
    """The documents as they are trained on, range-sorted: position, doc_id, source, pass, words (the first ones of the document)."""
    return mix.select("doc_id", "source", F.explode("passes").alias("p")).select("p.position", "doc_id", "source", "p.pass", "p.words").orderBy("position", "doc_id", "pass")


def by_position(mix: DataFrame) -> DataFrame:
    """One row per document, range-sorted by its first position; those that aren't taken come last."""
    first = F.when(F.size("passes") > 0, F.col("passes")[0]["position"])
    return mix.select("doc_id", "size", "source_size", "target", "taken", first.alias("position")).orderBy(F.col("position").asc_nulls_last(), "doc_id")
