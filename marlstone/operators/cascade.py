"""Decisions by rules first and by vectors last: only rows that no rule decides meet the vectors, and each result tells which step gave it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import slug
from ..sources.tables import stored
from . import vectors as V
from .aliases import alias_table
from .checks import sense_of

# What a text says that tells the type of its study; the first list with "flood" in the text, too.
FLOOD_CASE = (
    "tested on", "tested using", "we tested", "we applied", "applied to", "validated on", "evaluated on", "study area", "study site", "case study", "case area", "test site", "pilot area", "event occurred",
    "occurred in", "flood event", "flood events", "flooded area", "flood extent", "ground truth data", "post-flood", "preflood", "pre-flood",
)
GENERAL_CASE = (
    "tested on", "tested using", "we tested", "we applied", "applied to", "validated on", "evaluated on", "study area", "study site", "case study", "case area", "test site", "pilot area", "event occurred",
    "occurred in", "study was conducted", "dataset was collected",
)
REGIONAL = (
    "regional scale", "national scale", "country scale", "across the country", "entire country", "whole country", "territory of", "large region", "administrative region", "natural zones", "multiple stations",
    "weather stations", "meteorological stations",
)
MULTI_SITE = (
    "multiple case studies", "several case studies", "five case studies", "multiple locations", "multiple sites", "different locations", "different regions", "various regions", "multiple flood events",
    "several flood events", "two flood events", "different test sites", "benchmark sites",
)
GLOBAL = (
    "global scale", "global-scale", "worldwide", "anywhere in the world", "global application", "global flood monitoring", "global basis", "near real-time on a global basis", "globally available",
    "global datasets", "worldwide application",
)
REVIEW = ("systematic review", "literature review", "review paper", "this review", "we review", "review of", "state-of-the-art review", "survey of", "overview of", "meta-analysis")
WEAK_REVIEW = ("previous studies", "several studies", "many studies", "existing methods", "state of the art", "related work", "literature", "literature review")
SURE = 0.85  # of a vector's label; below it a judge is asked
LIKE = 0.82  # least cosine of a mention and the entity it is taken for


def _has(c: Column, words: Sequence[str]) -> Column:
    return F.coalesce(F.exists(F.array(*map(F.lit, words)), lambda w: c.contains(w)), F.lit(False))


def by_rules(heading: Column, body: Column) -> Column:
    """struct(label, confidence, source, needs_judge) by the first rule that decides, else null. heading: title and abstract; body: these and what the study says of itself."""
    head, text = F.lower(heading), F.lower(body)
    flood, general = _has(text, ("flood",)) & _has(text, FLOOD_CASE), _has(text, GENERAL_CASE)
    told = lambda label, sure, source, judge=F.lit(False): F.struct(F.lit(label).alias("label"), F.lit(sure).alias("confidence"), F.lit(source).alias("source"), judge.alias("needs_judge"))
    return (
        F.when(_has(head, REVIEW) & ~(flood | general), told("review", 0.95, "rules_title_abstract"))
        .when(_has(text, MULTI_SITE), told("multi_site", 0.88, "rules")).when(flood, told("case_study", 0.92, "rules_flood_case"))
        .when(_has(text, REGIONAL) & ~general, told("regional", 0.88, "rules")).when(general, told("case_study", 0.9, "rules"))
        .when(_has(text, GLOBAL), told("global_algorithmic", 0.85, "rules", _has(text, WEAK_REVIEW)))
    )


def study_types(texts: DataFrame, vectors: DataFrame, prototypes: DataFrame) -> DataFrame:
    """texts: text_id, heading, body; vectors: text_id, vec; prototypes: label, vec (a bounded list). text_id, label, confidence, source, needs_judge.

    Only undecided texts are joined with their vectors; a label's score is the mean cosine to its prototypes, which is the product with the mean of their directions. Without a usable vector the label is unknown."""
    judged = texts.withColumn("r", by_rules(F.col("heading"), F.col("body")))
    decided = judged.filter("r is not null").select("text_id", "r.*")
    left = judged.filter("r is null").select("text_id", _has(F.lower("body"), WEAK_REVIEW).alias("weak"))
    parts = prototypes.select("label", F.posexplode(V.unit(F.col("vec"))).alias("i", "x")).groupBy("label", "i").agg(F.avg("x").alias("x"))
    means = parts.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("mean")).agg(F.array_sort(F.collect_list(F.struct("label", "mean"))).alias("all"))
    own = left.join(vectors.select("text_id", V.unit(F.col("vec")).alias("u")), "text_id", "left").join(F.broadcast(means))
    # of equal scores the first label
    best = F.reduce("all", F.struct(F.lit(-2.0).alias("score"), F.lit("").alias("label")), lambda b, a: F.when(F.round(V.dot(a["mean"], F.col("u")), 9) > b["score"], F.struct(F.round(V.dot(a["mean"], F.col("u")), 9).alias("score"), a["label"].alias("label"))).otherwise(b))
    scored = own.withColumn("b", F.when(F.col("u").isNotNull(), best))
    none = F.col("b").isNull()
    fallback = scored.select(
        "text_id", F.when(none, "unknown").otherwise(F.col("b.label")).alias("label"), F.when(none, 0.4).otherwise(F.col("b.score")).alias("confidence"),
        F.when(none, "no_vector").otherwise("vectors").alias("source"), (none | (F.col("b.score") < SURE) | F.col("weak")).alias("needs_judge"),
    )
    return decided.unionByName(fallback)


def resolved(mentions: DataFrame, entities: DataFrame, senses: DataFrame, entity_vectors: DataFrame) -> DataFrame:
    """mentions: mention_id (long), name, expected_type (or null), context (or null), vec (or null); entities: entity_id, ord, name, aliases, type; senses as for checks.sense_of; entity_vectors: ord, vec.

    mention_id, entity_id, match, confidence by the first step that finds an entity of the expected type: the id itself (alias, 1.0), a sense that the context tells (disambiguation, 0.95, of any type), an alias (1.0), the
    displayed name (exact, 1.0), the nearest entity's vector from LIKE on (semantic, its cosine); else unknown (0). What a step decides isn't looked up again."""
    kinds = entities.select("entity_id", "type")
    aliases = stored(alias_table(entities).join(kinds, "entity_id"), "aliases")
    fits = F.col("expected_type").isNull() | (F.col("expected_type") == F.col("type"))
    rest, found = stored(mentions.withColumn("trimmed", F.trim("name")), "mentions"), []

    def taken(hits: DataFrame, match: str, sure) -> None:
        nonlocal rest
        hits = stored(hits.select("mention_id", "entity_id", F.lit(match).alias("match"), sure.cast("double").alias("confidence")), match)
        found.append(hits)
        rest = rest.join(hits.select("mention_id"), "mention_id", "left_anti")

    taken(rest.filter("trimmed like '%.%'").join(kinds, F.col("trimmed") == F.col("entity_id")).filter(fits), "alias", F.lit(1.0))
    told = sense_of(rest.filter("context is not null").select(F.col("mention_id").alias("text_id"), "name", "context"), senses).filter("sense is not null")
    taken(told.withColumn("alias", slug(F.col("sense"))).join(aliases, "alias").withColumnRenamed("text_id", "mention_id"), "disambiguation", F.lit(0.95))
    taken(rest.withColumn("alias", slug(F.col("name"))).join(aliases, "alias").filter(fits), "alias", F.lit(1.0))
    shown = entities.groupBy(F.lower("name").alias("shown"), "type").agg(F.min_by("entity_id", "ord").alias("entity_id"), F.min("ord").alias("ord"))
    exact = rest.join(shown, F.lower("trimmed") == F.col("shown")).filter(fits).groupBy("mention_id").agg(F.min_by("entity_id", "ord").alias("entity_id"))
    taken(exact, "exact", F.lit(1.0))
    # types are few; the mentions of each meet the vectors of its entities
    rest = stored(rest, "undecided")
    based = entity_vectors.join(entities.select("ord", "entity_id", "type"), "ord")
    for (kind,) in rest.filter("vec is not null").select("expected_type").distinct().collect():
        base = based if kind is None else based.filter(F.col("type") == kind)
        asked = rest.filter(F.col("expected_type").eqNullSafe(kind) & F.col("vec").isNotNull()).select((-1 - F.col("mention_id")).alias("vec_id"), F.col("vec").alias("embedding"))
        near = V.nearest(base.select(F.col("ord").cast("long").alias("vec_id"), F.col("vec").alias("embedding")), asked, 1).filter(F.col("similarity") >= LIKE)
        hits = near.join(entities.select(F.col("ord").alias("id"), "entity_id"), "id").select((-1 - F.col("query")).alias("mention_id"), "entity_id", "similarity")
        found.append(stored(hits.select("mention_id", "entity_id", F.lit("semantic").alias("match"), F.round("similarity", 6).alias("confidence")), "semantic"))
    every = reduce(DataFrame.unionByName, found)
    return mentions.select("mention_id").join(every, "mention_id", "left").select("mention_id", "entity_id", F.coalesce("match", F.lit("unknown")).alias("match"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"))
