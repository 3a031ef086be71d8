"""Entities found in text: scoring, acceptance, one row for each canonical name, contexts, rule tables joined to mentions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import stored

STRETCH = 100_000

# How much each kind of evidence weighs, what a section adds, and the score from which an entity is accepted.
EVIDENCE = {"pattern": 0.3, "context": 0.3, "embedding": 0.2, "llm": 0.2}
SECTION_BOOST = {"abstract": 0.20, "methods": 0.25, "conclusion": 0.15, "study_area": 0.10, "data_sources": 0.10}
ACCEPT_FROM = 0.3


def scored(mentions: DataFrame, blocked: list[str]) -> DataFrame:
    """mentions: doc, name, canonical, the four kinds of evidence and sections (array). One row for each doc and canonical name: the best mention that
    isn't blocked and is accepted, with its score. Ties: the name that sorts first."""
    base = sum((F.coalesce(F.col(k), F.lit(0.0)) * w for k, w in EVIDENCE.items()), F.lit(0.0))
    boost = sum((F.when(F.array_contains("sections", s), w).otherwise(F.lit(0.0)) for s, w in SECTION_BOOST.items()), F.lit(0.0))
    rows = mentions.filter(~F.lower("name").isin(*blocked)).withColumn("score", F.round(F.least(F.lit(1.0), base + boost), 4)).filter(F.col("score") >= ACCEPT_FROM)
    best = rows.groupBy("doc", "canonical").agg(F.min(F.struct((-F.col("score")).alias("s"), "name")).alias("b"))
    return best.select("doc", "canonical", "b.name", (-F.col("b.s")).alias("score"))


def best_context(text: str, word: str, cues: list[str], around: int = 80, most: int = 10) -> Column:
    """Of the first `most` places of the word, the stretch around one with the most cues; the first of equals."""
    # the text is cut at the word; the ends of two neighbours are the stretch around a place
    parts = F.split(F.col(text), rf"\Q{word}\E")

    def pick(p: Column) -> Column:
        places = F.transform(
            F.sequence(F.lit(1), F.greatest(F.least(F.size(p) - 1, F.lit(most)), F.lit(1))),
            lambda i: F.concat(F.right(F.element_at(p, i), F.lit(around)), F.lit(word), F.left(F.coalesce(F.get(p, i), F.lit("")), F.lit(around))),
        )
        ranked = F.transform(places, lambda s, k: F.struct(-sum((F.lower(s).contains(c).cast("int") for c in cues), F.lit(0)), k, s.alias("s")))
        return F.when(F.size(p) > 1, F.array_min(ranked)["s"])

    return F.element_at(F.transform(F.array(parts), pick), 1)


def region_class(roles: str, caption: str, width: Column, height: Column) -> Column:
    """A region's class by the roles of its blocks: formula before table before figures."""
    has = lambda r: F.array_contains(roles, r)
    chart = F.lower(F.coalesce(F.col(caption), F.lit(""))).rlike("chart|hydrograph|map|diagram|watershed|basin|catchment|dem|spatial|contour|raster|satellite")
    panels = F.size(F.filter(roles, lambda r: r == "graphic")) >= 2
    figure = has("figure") | has("graphic") | has("figure_caption")
    return (
        F.when(has("formula"), "FORMULA_REGION").when(has("table") | has("table_caption"), "TABLE_REGION").when(figure & panels, "MULTI_PANEL_FIGURE")
        .when(figure & chart, "CHART_REGION").when(figure & (width > 300) & (height > 200), "SCIENTIFIC_DIAGRAM").otherwise("FIGURE_REGION")
    )


def triage(encrypted: Column, pages: Column, sampled: Column, without_text: Column, chars: Column, most_pages: int = 500, scanned: float = 0.75) -> Column:
    """What becomes of a file: the reason to skip it, or 'ok'."""
    return (
        F.when(encrypted, "encrypted").when(pages > most_pages, "too many pages").when(pages == 0, "corrupted")
        .when(without_text / F.greatest(sampled, F.lit(1)) >= scanned, "scanned").when(chars == 0, "no text").otherwise("ok")
    )


def metric_rows(docs: DataFrame, id_col: str, text_col: str, patterns: list[tuple[str, str]], guard: str, around: int = 120) -> DataFrame:
    """(id, metric, raw, confidence): values by pattern in order, kept where the guard isn't within `around` characters, once for each metric and value;
    a generic 'percent' goes if a named metric has its value. Each pattern's first group is the value."""
    found = []
    for k, (metric, pattern) in enumerate(patterns):
        hits = F.regexp_extract_all(text_col, F.lit(pattern), F.lit(1))
        near = F.regexp_extract_all(text_col, F.lit(rf"(?:{guard})[^\n]{{0,{around}}}?{pattern}"), F.lit(1))
        kept = F.array_distinct(F.array_except(hits, near))
        found.append(docs.select(id_col, F.lit(metric).alias("metric"), F.lit(k).alias("ord"), F.explode(kept).alias("raw")))
    rows = found[0]
    for f in found[1:]:
        rows = rows.unionByName(f)
    named = rows.filter("metric <> 'percent'").select(id_col, "raw").distinct()
    kept = rows.filter("metric <> 'percent'").unionByName(rows.filter("metric = 'percent'").join(named, [id_col, "raw"], "left_anti"))
    return kept.select(id_col, "metric", "raw", F.when(F.col("metric") == "percent", 0.5).otherwise(0.7).alias("confidence")).distinct()


def layout_chunks(docs: DataFrame, id_col: str, text_col: str, least: int = 20) -> DataFrame:
    """Paragraphs as chunks with ids of their content's place: chunk_id, place, chunk. Chunks with fewer characters are left out."""
    rows = docs.select(F.col(id_col), F.posexplode(F.split(text_col, "\n")).alias("place", "chunk")).filter(F.length("chunk") >= least)
    key = F.concat(F.substring(F.col(id_col).cast("string"), 1, 16), F.lit(":p"), F.col("place").cast("string"))
    return rows.select(F.substring(F.sha1(key), 1, 20).alias("chunk_id"), id_col, "place", "chunk")


def hierarchy(children: DataFrame, rules: DataFrame) -> DataFrame:
    """child, parent: of the rules (pattern, parent, priority) the first that fits a child; small tables of rules go to all tasks."""
    hit = children.join(F.broadcast(rules), F.rlike(F.col("child"), F.col("pattern")))
    first = hit.groupBy("child").agg(F.min(F.struct("priority", "parent")).alias("b"))
    return children.select("child").distinct().join(first, "child", "left").select("child", F.col("b.parent").alias("parent"))


def coupled(rows: DataFrame, id_col: str, methods: str, pairs: list[tuple[str, str]]) -> DataFrame:
    """Pairs of methods that occur together in a row's array, in the order of the pairs given."""
    both = F.filter(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in pairs]), lambda p: F.array_contains(methods, p["a"]) & F.array_contains(methods, p["b"]))
    return rows.select(id_col, F.explode(both).alias("p")).select(id_col, "p.a", "p.b")


def numbered(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """follows: the id of the row before in the group, by an order of numbers that begins with `order`.

    A group is cut into stretches of STRETCH by the first of them, so that a hot group isn't sorted in one task; the first row of a stretch follows the last one of
    the nearest stretch before it, of which each has one row.
    """
    placed = rows.withColumn("_stretch", F.floor(F.col(order[0]) / STRETCH))
    inner = Window.partitionBy(group, "_stretch").orderBy(*order)
    placed = placed.withColumn("follows", F.lag("id").over(inner)).withColumn("_first", F.row_number().over(inner) == 1)
    last = stored(placed.groupBy(group, "_stretch").agg(F.max_by("id", F.struct(*order)).alias("_last")), "stretches")
    last = last.withColumn("_before", F.lag("_last").over(Window.partitionBy(group).orderBy("_stretch"))).drop("_last")
    met = placed.filter("_first").join(stored(last, "stretches"), [group, "_stretch"]).withColumn("follows", F.col("_before")).drop("_before")
    return placed.filter("not _first").unionByName(met).drop("_stretch", "_first")
