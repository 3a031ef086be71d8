"""Cleaning and merging of extracted records: metric scans by ordered patterns, validity, source precedence, alias patches, changes between two states."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import slug

# Sections that a metric or a method may come from, and names of countries that say nothing.
METRIC_SECTIONS = ("results", "table", "sodb_parquet", "paper_entities")
METHOD_SECTIONS = ("methods", "abstract+methods")
NO_COUNTRY = ("study area", "the study area", "study region")
# Families of methods by the domain of their registry entry.
DOMAIN_FAMILIES = {"hydrology": "Hydrological Models", "terrain_analysis": "Terrain Analysis", "flood_mapping": "Flood Mapping Methods", "remote_sensing": "Image Processing"}
JUDGE_BELOW = 0.85


def as_ratio(c: Column) -> Column:
    """A number of a text as a share: percentages of more than one are divided by a hundred."""
    v = F.regexp_replace(c, ",", ".").try_cast("double")
    return F.when(v > 1, v / 100).otherwise(v)


def scanned(text: Column, patterns: Sequence[tuple[str, int]], low: float, high: float) -> Column:
    """The first plausible value in order of patterns, then of places. patterns: (regular expression, number of groups): with two groups the value is the middle of a range in order."""
    found = []
    for pattern, groups in patterns:
        first = F.transform(F.regexp_extract_all(text, F.lit(f"(?i){pattern}"), F.lit(1)), lambda x: as_ratio(x))
        if groups == 1:
            found.append(F.filter(first, lambda v: v.between(low, high)))
            continue
        second = F.transform(F.regexp_extract_all(text, F.lit(f"(?i){pattern}"), F.lit(2)), lambda x: as_ratio(x))
        ranges = F.filter(F.zip_with(first, second, lambda a, b: F.struct(a.alias("a"), b.alias("b"))), lambda r: (r["a"] >= low) & (r["a"] <= r["b"]) & (r["b"] <= high))
        found.append(F.transform(ranges, lambda r: (r["a"] + r["b"]) / 2))
    return F.round(F.try_element_at(F.concat(*found), F.lit(1)), 4)


def rejection(metric: Column, metric_section: Column, methods: Column, methods_section: Column, country: Column) -> Column:
    """Why a record is rejected, null if it isn't: a metric or methods from a wrong section, or a country that is none. An unknown section is no reason."""
    wrong_metric = metric.isNotNull() & (F.coalesce(metric_section, F.lit("")) != "") & ~metric_section.isin(*METRIC_SECTIONS)
    wrong_methods = (F.coalesce(methods, F.lit("")) != "") & (F.coalesce(methods_section, F.lit("")) != "") & ~methods_section.isin(*METHOD_SECTIONS)
    generic = F.regexp_replace(F.trim(F.lower(country)), r"\.+$", "").isin(*NO_COUNTRY)
    return F.when(wrong_metric, "metric_section").when(wrong_methods, "methods_section").when(F.coalesce(generic, F.lit(False)), "generic_country")


def canonical_list(c: Column, names: dict[str, str]) -> Column:
    """A comma-joined list with names in their canonical form, each once, in order of first sight; null if none."""
    known = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    parts = F.filter(F.transform(F.split(c, ","), lambda p: F.trim(p)), lambda p: p != "")
    return F.nullif(F.array_join(F.array_distinct(F.transform(parts, lambda p: F.coalesce(F.try_element_at(known, F.lower(p)), p))), ", "), F.lit(""))


def filled_by_precedence(candidates: DataFrame, key: str, field: str, sources: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """candidates: key, field, source, value, confidence. (for each key and field the value of the first source that has one, of greatest confidence there; all candidates as evidence, with whether they were taken)."""
    rank = F.array_position(F.array(*[F.lit(s) for s in sources]), F.col("source"))
    rows = candidates.filter("value is not null").withColumn("_rank", F.when(rank == 0, len(sources) + 1).otherwise(rank))
    best = rows.groupBy(key, field).agg(F.min(F.struct("_rank", (-F.col("confidence")).alias("c"), "value", "source")).alias("b"))
    taken = best.select(key, field, F.col("b.value").alias("value"), F.col("b.source").alias("source"))
    evidence = rows.drop("_rank").join(taken.withColumnsRenamed({"value": "_v", "source": "_s"}), [key, field])
    return taken, evidence.withColumn("taken", (F.col("value") == F.col("_v")) & (F.col("source") == F.col("_s"))).drop("_v", "_s")


def gated(rows: DataFrame, weak: Column) -> DataFrame:
    """Adds needs_judge, and with a verdict (accepted, verdict_confidence; null without one) whether a row stays and its confidence: the verdict's where a judge was asked, else its own."""
    asked = (F.col("confidence") < JUDGE_BELOW) | F.coalesce(weak, F.lit(False))
    told = asked & F.col("accepted").isNotNull()
    return rows.withColumn("needs_judge", asked).withColumn("stays", F.when(told, F.col("accepted")).otherwise(F.lit(True))).withColumn("confidence", F.when(told, F.col("verdict_confidence")).otherwise(F.col("confidence")))


def expanded(entities: DataFrame, patches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """entities: entity_id, name, aliases; patches: entity_id, alias. (entities with the patches' new aliases; one row of what happened to each patch: added, duplicate or missing_target)."""
    own = entities.select("entity_id", F.explode(F.array_union(F.transform("aliases", lambda a: slug(a)), F.array(slug(F.col("name")), slug(F.col("entity_id"))))).alias("slug")).distinct()
    asked = patches.filter(F.trim("alias") != "").withColumn("slug", slug(F.col("alias")))
    asked = asked.groupBy("entity_id", "slug").agg(F.min("alias").alias("alias"))
    known = asked.join(entities.select("entity_id", F.lit(True).alias("_there")), "entity_id", "left").join(own.withColumn("_claimed", F.lit(True)), ["entity_id", "slug"], "left")
    told = known.select("entity_id", "alias", F.when(F.col("_there").isNull(), "missing_target").when(F.col("_claimed").isNotNull(), "duplicate").otherwise("added").alias("outcome"))
    new = told.filter("outcome = 'added'").groupBy("entity_id").agg(F.array_sort(F.collect_list("alias")).alias("_new"))
    return entities.join(new, "entity_id", "left").withColumn("aliases", F.concat("aliases", F.coalesce("_new", F.array().cast("array<string>")))).drop("_new"), told


def changes(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """key and how its row differs: added, removed or changed."""
    columns = [c for c in before.columns if c != key]
    a = before.select(F.col(key), F.xxhash64(*columns).alias("_a"))
    b = after.select(F.col(key), F.xxhash64(*columns).alias("_b"))
    met = a.join(b, key, "full")
    how = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").when(F.col("_a") != F.col("_b"), "changed")
    return met.select(key, how.alias("how")).filter("how is not null")


def method_family(method: Column, domain: Column, overrides: dict[str, Sequence[str]]) -> Column:
    """The family whose list names the method, else the family of its domain, else Other."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for family, ids in overrides.items():
        out = out.when(method.isin(*ids), family)
    known = F.create_map(*[F.lit(x) for pair in DOMAIN_FAMILIES.items() for x in pair])
    return F.coalesce(out, F.try_element_at(known, domain), F.lit("Other"))
