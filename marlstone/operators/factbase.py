"""Atomic facts from the elements found in papers: six kinds in one table, each with evidence, linked to the facts of its paper that it rests on, and checked by rules of its kind.

A fact's id is a digest of its paper, kind and content, so that the same elements give the same ids and repeated ones the same fact. Links: a result to the paper's methods; a method to its data sources and study area;
a data source to the study area; a task to methods, sources and area; a property to sources and methods. They are arrays of ids, no longer than the number of different methods and sources that a paper names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Satellites that need no evidence text.
KNOWN_SATELLITES = (
    "Sentinel-1", "Sentinel-2", "TerraSAR-X", "TanDEM-X", "COSMO-SkyMed", "ALOS-2", "ALOS PALSAR", "RADARSAT-2", "RADARSAT-1", "UAVSAR", "ICEYE", "Capella", "ERS-2", "ERS-1", "Envisat", "NovaSAR",
    "Landsat-9", "Landsat-8", "Landsat-7", "Landsat-5", "Landsat", "MODIS", "VIIRS", "WorldView-3", "WorldView-2", "Pleiades", "PlanetScope", "SPOT-7", "SPOT-6", "SPOT-5", "ICESat-2",
)
# Study areas that name no place.
GENERIC_AREAS = ("study area", "the study area", "study region", "case study", "region", "area", "location")
# Sections whose evidence counts for a method and for a result.
METHOD_SECTIONS, RESULT_SECTIONS = ("methods", "abstract+methods"), ("results",)

_EVIDENCE = "array<struct<text:string,section:string,field:string,source:string>>"
_COLUMNS = ("paper_id", "fact_type", "name", "detail", "value", "unit", "evidence")


def evidence(snippet: Column, section: Column, field: Column, source: str) -> Column:
    """An array of the one piece of evidence, or of none where there is no snippet; 200 characters of it."""
    piece = F.struct(F.left(snippet, F.lit(200)).alias("text"), section.alias("section"), field.alias("field"), F.lit(source).alias("source"))
    return F.when(F.length(snippet) > 0, F.array(piece)).otherwise(F.array().cast(_EVIDENCE)).cast(_EVIDENCE)


def _typed(rows: DataFrame, kind: str, name: Column, found: Column, detail: Column | None = None, value: Column | None = None, unit: Column | None = None) -> DataFrame:
    null = F.lit(None).cast("string")
    columns = (F.col("paper_id").cast("string"), F.lit(kind), name, null if detail is None else detail, F.lit(None).cast("double") if value is None else value.cast("double"), null if unit is None else unit, found)
    return rows.select(*[c.alias(n) for c, n in zip(columns, _COLUMNS)])


def atomic_facts(sources: DataFrame, methods: DataFrame, metrics: DataFrame, areas: DataFrame, tasks: DataFrame, properties: DataFrame) -> DataFrame:
    """fact_id, the columns of a fact, related_fact_ids and reasons (why it isn't valid; empty if it is).

    All tables have paper_id and snippet; sources name and sensor_type, methods name, category and section, metrics type, value, unit and section, areas country, region and river_basin, tasks task and section,
    properties value. Rows without content make no fact."""
    c = F.col
    section = lambda df, default: F.coalesce(c("section"), F.lit(default)) if "section" in df.columns else F.lit(default)
    area = F.nullif(F.concat_ws(" / ", F.nullif("country", F.lit("")), F.nullif("region", F.lit("")), F.nullif("river_basin", F.lit(""))), F.lit(""))
    kinds = [
        _typed(sources, "data_source", c("name"), evidence(c("snippet"), F.lit("abstract+methods"), F.lit("Satellite_Names"), "regex"), c("sensor_type")),
        _typed(methods, "method", c("name"), evidence(c("snippet"), section(methods, "methods"), F.lit("Methods"), "regex"), c("category")),
        _typed(metrics, "result", c("type"), evidence(c("snippet"), section(metrics, "results"), c("type"), "regex"), value=c("value"), unit=c("unit")),
        _typed(areas, "study_area", area, evidence(c("snippet"), F.lit("abstract+introduction"), F.lit("Country"), "regex")),
        _typed(tasks, "task", c("task"), evidence(c("snippet"), section(tasks, "abstract"), F.lit("Task"), "rule")),
        _typed(properties, "system_property", c("value"), evidence(c("snippet"), F.lit("abstract+methods"), F.lit("Near_Real_Time"), "regex")),
    ]
    facts = reduce(DataFrame.unionByName, kinds).filter("length(name) > 0 and paper_id is not null")
    told = F.concat_ws("|", "paper_id", "fact_type", "name", F.coalesce(c("value").cast("string"), F.lit("")), F.coalesce("unit", F.lit("")))
    facts = facts.withColumn("fact_id", F.md5(told)).groupBy("fact_id", *[n for n in _COLUMNS if n not in ("detail", "evidence")]).agg(F.max("detail").alias("detail"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("evidence")))).alias("evidence"))
    of = lambda kind: F.array_sort(F.collect_set(F.when(c("fact_type") == kind, c("fact_id"))))
    per = facts.groupBy(c("paper_id").alias("of_paper")).agg(of("data_source").alias("ds"), of("method").alias("me"), of("study_area").alias("sa"))
    links = (
        F.when(c("fact_type") == "result", c("me")).when(c("fact_type") == "method", F.concat("ds", "sa")).when(c("fact_type") == "data_source", c("sa"))
        .when(c("fact_type") == "task", F.concat("me", "ds", "sa")).when(c("fact_type") == "system_property", F.concat("ds", "me")).otherwise(F.array().cast("array<string>"))
    )
    linked = facts.join(per, c("paper_id") == c("of_paper")).withColumn("related_fact_ids", links)
    return linked.withColumn("reasons", reasons()).select("fact_id", "paper_id", "fact_type", "name", "detail", "value", "unit", "evidence", "related_fact_ids", "reasons")


def reasons() -> Column:
    """Why a fact isn't accepted."""
    c = F.col
    sections = F.transform("evidence", lambda e: e["section"])
    elsewhere = lambda allowed: (F.size("evidence") > 0) & ~F.exists(sections, lambda s: s.isin(*allowed))
    known = c("name").isin(*KNOWN_SATELLITES)
    rules = [
        F.when(F.size("evidence") == 0, "no evidence"),
        F.when((c("fact_type") == "data_source") & ~known & (F.size("evidence") == 0), "unknown satellite without evidence"),
        F.when((c("fact_type") == "study_area") & F.exists(F.split(F.lower("name"), " / "), lambda a: F.rtrim(F.trim(a), F.lit(".")).isin(*GENERIC_AREAS)), "no place named"),
        F.when((c("fact_type") == "method") & elsewhere(METHOD_SECTIONS), "evidence outside methods"),
        F.when((c("fact_type") == "result") & elsewhere(RESULT_SECTIONS), "evidence outside results"),
    ]
    return F.array_compact(F.array(*rules))


def fact_edges(facts: DataFrame) -> DataFrame:
    """(src, dst, rel, src_type, dst_type): the links as typed edges; both ends are facts of the table."""
    named = {("result", "method"): "EVALUATES", ("method", "data_source"): "APPLIED_TO", ("task", "method"): "USES", ("system_property", "data_source"): "RUNS_ON"}
    rel = F.lit("RELATED_TO")
    for (a, b), name in named.items():
        rel = F.when((F.col("src_type") == a) & (F.col("dst_type") == b), name).otherwise(rel)
    out = facts.select(F.col("fact_id").alias("src"), F.col("fact_type").alias("src_type"), F.explode("related_fact_ids").alias("dst"))
    return out.join(facts.select(F.col("fact_id").alias("dst"), F.col("fact_type").alias("dst_type")), "dst").select("src", "dst", rel.alias("rel"), "src_type", "dst_type")
