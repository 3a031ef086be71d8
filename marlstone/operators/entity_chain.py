"""The chain that decides on entities of documents: blocked names, best context, evidence of the context, role, sense, score with what sections add, one row for each canonical name.

Entities: doc, name, canonical, pattern, embedding, llm (null: 0). Documents: doc (unique), title, sections (map of a section's name to its text). Senses: name, sense, ord, signals, excludes (arrays), fallback. Defined cases: null
names are blocked; an entity of an unknown document or one that its text doesn't hold has an empty context; those without a canonical name stay as they are; of equal scores the name that sorts first stays.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .checks import sent
from .entities import ACCEPT_FROM, EVIDENCE, SECTION_BOOST

TITLE_BOOST, AROUND, PLACES = 0.25, 500, 10
# Names that are no entities, and the cues of contexts.
BLOCKED = (
    "HTTP", "HTTPS", "URL", "WWW", "J", "R", "T", "K", "S", "M", "N", "NNT", "NET", "REF", "TAG", "ALS", "CLASSIFICATION", "REMOTE", "SENSING", "ANALYSIS", "PROCESS", "PROCESSING", "DATA", "MAP", "MAPPING",
    "STUDY", "AREA", "REGION", "TABLE", "FIGURE", "FIG", "MM", "CM", "KM", "M2", "KM2", "HA", "HZ", "DB",
)
CONTEXT_CUES = (
    "study area", "study site", "tested on", "test site", "flood event", "flood events", "occurred in", "located in", "case study", "data sources", "ground truth", "validation data",
)
PLACE_CUES = ("study area", "case study", "located in", "study site", "basin")
USE_CUES = ("used", "applied", "analysis", "simulation")
ROLE_CUES = ("used", "applied", "model", "analysis", "derived from", "calculated")


def _any(low: Column, words: Sequence[str]) -> Column:
    return F.exists(F.array(*map(F.lit, words)), lambda w: low.contains(w))


def context_of(text: Column, name: Column, cues: Sequence[str] = CONTEXT_CUES, around: int = AROUND, most: int = PLACES) -> Column:
    """Of the first `most` places of a name (in either case), the stretch around one with most cues, of equals the first; empty without any."""
    literal = F.concat(F.lit(r"(?i)\Q"), F.replace(name, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
    parts = F.split(text, literal, F.lit(most + 1))
    length = F.length(name)

    def places(p: Column) -> Column:
        # where each part but the last ends, that is where the name stands
        ends = F.aggregate(F.slice(p, F.lit(1), F.size(p) - 1), F.array().cast("array<int>"), lambda a, x: F.concat(a, F.array(F.coalesce(F.try_element_at(a, F.lit(-1)) + length, F.lit(0)) + F.length(x))))
        begin = lambda at: F.greatest(at - around, F.lit(0))
        cut = F.transform(ends, lambda at: F.trim(F.regexp_replace(F.substr(text, begin(at) + 1, at + length + around - begin(at)), r"\s+", " ")))
        return F.transform(cut, lambda s, k: F.struct(-F.size(F.filter(F.array(*map(F.lit, cues)), lambda c: F.lower(s).contains(c))), k, s.alias("s")))

    best = F.element_at(F.transform(F.array(parts), lambda p: F.array_min(places(p))["s"]), 1)
    return F.coalesce(F.when((text != "") & (name != ""), best), F.lit(""))


def sense_in(low: Column, senses: Column) -> Column:
    """Of an array of senses the one with most signals less excludes in a context in lower case, of equals the first; without any the fallback; null without senses."""
    count = lambda words: F.size(F.filter(F.coalesce(words, F.array().cast("array<string>")), lambda w: low.contains(w)))
    best = F.array_max(F.transform(senses, lambda s: F.struct(F.greatest(F.lit(0), count(s["signals"]) - count(s["excludes"])).alias("hits"), (-s["ord"]).alias("k"), s["sense"].alias("sense"))))
    other = F.array_max(F.transform(F.filter(senses, lambda s: s["fallback"]), lambda s: s["sense"]))
    return F.when(best["hits"] > 0, best["sense"]).otherwise(other)


def chained(entities: DataFrame, documents: DataFrame, senses: DataFrame, blocked: Sequence[str] = BLOCKED, accept: float = ACCEPT_FROM, around: int = AROUND) -> DataFrame:
    """doc, name, canonical, role, context_score, score, accepted, evidence, alt_evidence (that of the next best entity of the same canonical name).

    Texts are moved once, to their document's entities; all that follows stays in the tasks of that join, since its groups lie within a document."""
    trimmed = F.trim(F.coalesce("name", F.lit("")))
    kept = entities.filter((F.length(trimmed) > 1) & ~F.upper(trimmed).isin(*blocked)).select("doc", trimmed.alias("name"), "canonical", *[k for k in EVIDENCE if k != "context"])
    whole = documents.select("doc", F.coalesce("title", F.lit("")).alias("_title"), F.col("sections").alias("_sections"), F.array_join(F.map_values("sections"), " ").alias("_text"))
    met = kept.join(whole, "doc", "left")
    # what a document's text says of each name, once for each; from here on without texts
    low = F.lower("name")
    holds = lambda c: F.coalesce(F.lower(c).contains(low), F.lit(False))
    boost = F.when(holds(F.col("_title")), TITLE_BOOST).otherwise(0.0)
    for section, weight in SECTION_BOOST.items():
        boost = boost + F.when(holds(F.try_element_at("_sections", F.lit(section))), weight).otherwise(0.0)
    evidence = {k: F.coalesce(k, F.lit(0.0)).alias(k) for k in EVIDENCE if k != "context"}
    rows = met.select("doc", "name", "canonical", *evidence.values(), boost.alias("_boost"), context_of(F.coalesce("_text", F.lit("")), F.col("name"), around=around).alias("evidence"))
    near = F.lower("evidence")
    rows = rows.withColumn("context", F.when(_any(near, PLACE_CUES), 0.5).otherwise(0.0) + F.when(_any(near, USE_CUES), 0.3).otherwise(0.0)).withColumn("role", F.when(_any(near, ROLE_CUES), "used").otherwise("mentioned"))
    # names of several senses: the sense tells the canonical name; senses are looked up in an array for each name, so that rows stay where their document is
    told = senses.groupBy("name").agg(F.collect_list(F.struct("sense", "ord", "signals", "excludes", "fallback")).alias("_senses"))
    rows = rows.join(sent(told), "name", "left").withColumn("canonical", F.coalesce(sense_in(near, F.col("_senses")), "canonical")).drop("_senses")
    base = F.round(sum((F.col(k) * w for k, w in EVIDENCE.items()), F.lit(0.0)), 4)
    rows = rows.withColumn("score", F.least(F.lit(1.0), F.round(base + F.col("_boost"), 4))).withColumn("accepted", F.col("score") >= accept)
    rows = rows.select("doc", "name", "canonical", "role", F.col("context").alias("context_score"), "score", "accepted", "evidence")
    # what has no canonical name is kept whole, beside those that are ranked
    bare = F.coalesce("canonical", F.lit("")) == ""
    order = Window.partitionBy("doc", "_bare", F.lower("canonical")).orderBy(F.desc("score"), "name", "evidence")
    ranked = rows.withColumn("_bare", bare).withColumns({"_rank": F.row_number().over(order), "alt_evidence": F.lead("evidence").over(order)}).filter("_bare or _rank = 1")
    return ranked.withColumn("alt_evidence", F.when(~F.col("_bare"), F.col("alt_evidence"))).select(*rows.columns, "alt_evidence")
