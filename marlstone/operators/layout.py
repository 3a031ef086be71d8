"""Chunks and rows of documents with a layout: sections in reading order, sentences with boxes on pages, floats (figures, tables, formulas).

Defined cases: an element without a readable box has page 0, no box and nothing near it; boxes that can't be read are left out, the others stay; null and empty texts give no chunk, nor
do texts shorter than the least length; a float is told by its caption, else its label; sections deeper than DEEPEST count as lying at that depth; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NEAR, LEAST, DEEPEST = 150.0, 20, 6
_REAL = r"\s*[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\s*"
_BOX = rf"^\s*[+-]?\d+\s*(?:,{_REAL}){{4}}$"


class Layout(NamedTuple):
    """The parts of documents; coords are `page,x,y,w,h` with `;` between boxes."""

    sections: DataFrame  # doc, section (from 0, in reading order), title, level (from 1), n, coords
    sentences: DataFrame  # doc, section, paragraph, place, text, citations (array), coords, paragraph_coords (alike within a paragraph)
    floats: DataFrame  # doc, kind (figure, table, formula), ord (from 0 in its kind), xml_id, label, text, coords, cells (array of arrays)
    abstracts: DataFrame  # doc, text


def boxes(coords: Column | str) -> Column:
    """An array of (page, x, y, w, h), null if no box can be read."""
    c = F.col(coords) if isinstance(coords, str) else coords
    cut = F.transform(F.filter(F.split(c, ";"), lambda s: s.rlike(_BOX)), lambda s: F.split(s, ","))
    told = F.transform(cut, lambda p: F.struct(F.trim(p[0]).try_cast("int").alias("page"), *[p[k].try_cast("double").alias(a) for k, a in enumerate("xywh", 1)]))
    read = F.filter(told, lambda b: b["page"].isNotNull())
    return F.when(F.size(read) > 0, read)


def nearest_floats(elements: DataFrame, keys: Sequence[str], floats: DataFrame, within: float = NEAR) -> DataFrame:
    """keys, figure, table: for each element (keys, with doc among them, and coords) that has one near it, the nearest figure and table as (distance squared, ord, xml_id).

    Distances are those of the centres of any two boxes on one page; ties: the first of the floats. Pages are cut into squares as wide as the distance, and a float
    is dealt out to the nine around it, so that neither a document nor a page is one group.
    """

    def centres(rows: DataFrame, *keep: str) -> DataFrame:
        b = F.col("_b")
        placed = rows.select(*keep, F.explode(boxes("coords")).alias("_b")).select(*keep, b["page"].alias("_page"), (b["x"] + b["w"] / 2).alias("_x"), (b["y"] + b["h"] / 2).alias("_y"))
        return placed.withColumns({"_i": F.floor(F.col("_x") / within), "_j": F.floor(F.col("_y") / within)})

    around = F.explode(F.expr("flatten(transform(sequence(-1, 1), i -> transform(sequence(-1, 1), j -> struct(i as i, j as j))))"))
    f = centres(floats.filter("kind in ('figure', 'table')"), "doc", "kind", "ord", "xml_id").withColumn("_d", around)
    f = f.select("doc", "_page", "kind", "ord", "xml_id", F.col("_x").alias("_fx"), F.col("_y").alias("_fy"), (F.col("_i") + F.col("_d.i")).alias("_i"), (F.col("_j") + F.col("_d.j")).alias("_j"))
    square = lambda a, b: (F.col(a) - F.col(b)) * (F.col(a) - F.col(b))
    met = centres(elements, *keys).join(f, ["doc", "_page", "_i", "_j"]).withColumn("d", square("_x", "_fx") + square("_y", "_fy")).filter(F.col("d") <= within * within)
    best = lambda kind: F.min(F.when(F.col("kind") == kind, F.struct("d", "ord", "xml_id"))).alias(kind)
    return met.groupBy(*keys).agg(best("figure"), best("table"))


def _chunk(rows: DataFrame, kind: str, key: Column, title: Column, level: Column, n: Column, least: int) -> DataFrame:
    """One kind of chunks; rows have doc, text, coords, citations, figure and table."""
    box = F.get(boxes("coords"), F.lit(0))
    told = rows.filter(F.length("text") >= least).withColumn("_box", box)
    place = F.concat(F.substring(F.col("doc").cast("string"), 1, 16), F.lit(":"), key)
    return told.select(
        F.substring(F.sha1(place), 1, 20).alias("chunk_id"), "doc", F.lit(kind).alias("chunk_type"), "text", title.alias("section_title"), level.cast("int").alias("section_level"), n.alias("section_n"),
        F.coalesce("_box.page", F.lit(0)).alias("page"), "_box.x", "_box.y", "_box.w", "_box.h", F.col("figure").isNotNull().alias("near_figure"), F.col("figure.xml_id").alias("figure_id"),
        F.col("table").isNotNull().alias("near_table"), F.col("table.xml_id").alias("table_id"), F.coalesce("citations", F.array().cast("array<string>")).alias("citations"),
    )


_NOTHING = "struct<d: double, ord: int, xml_id: string>"


def _alone(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"figure": F.lit(None).cast(_NOTHING), "table": F.lit(None).cast(_NOTHING)})


def paragraphs(layout: Layout) -> DataFrame:
    """doc, section, paragraph, text, citations, coords: sentences in order with a space between them."""
    per = layout.sentences.groupBy("doc", "section", "paragraph").agg(F.array_sort(F.collect_list(F.struct("place", "text", "citations"))).alias("_s"), F.first("paragraph_coords", ignorenulls=True).alias("coords"))
    return per.select("doc", "section", "paragraph", F.array_join("_s.text", " ").alias("text"), F.flatten(F.array_compact("_s.citations")).alias("citations"), "coords")


def within_sections(sections: DataFrame) -> DataFrame:
    """doc, section, within: each section with itself and all sections that it lies in, by the levels before it in reading order."""
    level = F.least(F.col("level"), F.lit(DEEPEST))
    order = Window.partitionBy("doc").orderBy("section").rowsBetween(Window.unboundedPreceding, -1)
    rows = sections.select("doc", "section", level.alias("_level"))
    rows = rows.withColumns({f"_at{k}": F.coalesce(F.max(F.when(F.col("_level") == k, F.col("section"))).over(order), F.lit(-1)) for k in range(1, DEEPEST)})
    # the last section of a level is still open if none of a higher level came after it
    still = lambda k: (F.col("_level") > k) & (F.col(f"_at{k}") >= 0) & (F.col(f"_at{k}") > F.greatest(F.lit(-1), F.lit(-1), *[F.col(f"_at{j}") for j in range(1, k)]))
    lies = F.array_compact(F.array(F.col("section"), *[F.when(still(k), F.col(f"_at{k}")) for k in range(1, DEEPEST)]))
    return rows.select("doc", "section", F.explode(lies).alias("within"))


def section_texts(layout: Layout) -> DataFrame:
    """doc, section, text, citations: the paragraphs of a section and of those inside it, in reading order, an empty line between them."""
    inside = paragraphs(layout).filter("text <> ''").join(within_sections(layout.sections), ["doc", "section"])
    per = inside.groupBy("doc", F.col("within").alias("section")).agg(F.array_sort(F.collect_list(F.struct(F.col("section").alias("s"), "paragraph", "text", "citations"))).alias("_p"))
    return per.select("doc", "section", F.array_join("_p.text", "\n\n").alias("text"), F.flatten("_p.citations").alias("citations"))


def chunks(layout: Layout, strategies: Sequence[str] = ("sentence",), within: float = NEAR, least: int = LEAST) -> DataFrame:
    """chunk_id, doc, chunk_type, text, section_title, section_level, section_n, page, x, y, w, h, near_figure, figure_id, near_table, table_id, citations.

    An abstract is one chunk; the body is cut into sentences, paragraphs or whole sections (one strategy or several); figures, tables and formulas are chunks of
    their own. Sentences and paragraphs are flagged by the nearest figure and table on their page.
    """
    unknown = set(strategies) - {"sentence", "paragraph", "section"}
    if unknown:
        raise ValueError(f"unknown strategies: {sorted(unknown)}")
    none = F.lit(None).cast("array<string>")
    names = layout.sections.select("doc", "section", F.coalesce("title", F.lit("")).alias("title"), "level", F.coalesce("n", F.lit("")).alias("n"))
    named = lambda most: F.when(F.col("n") != "", F.col("n")).otherwise(F.substring("title", 1, most))
    about = (F.col("title"), F.col("level"), F.col("n"))

    def placed(elements: DataFrame, keys: list[str]) -> DataFrame:
        # keys with names and floats, once each and without texts, so that texts are moved once
        return elements.select(*keys).join(names, ["doc", "section"]).dropDuplicates(keys).join(nearest_floats(elements, keys, layout.floats, within), keys, "left")

    abstract = _alone(layout.abstracts.select("doc", "text", F.lit(None).cast("string").alias("coords"), none.alias("citations")))
    out = [_chunk(abstract, "abstract", F.lit("abstract"), F.lit("Abstract"), F.lit(0), F.lit(""), least).withColumn("page", F.lit(1))]
    if "sentence" in strategies:
        keys = ["doc", "section", "paragraph", "place"]
        rows = layout.sentences.join(placed(layout.sentences, keys), keys)
        signed = F.concat_ws("_", named(12), F.col("place").cast("string"), F.substring(F.sha1("text"), 1, 8))
        out.append(_chunk(rows, "sentence", signed, *about, least))
    if "paragraph" in strategies:
        keys, para = ["doc", "section", "paragraph"], paragraphs(layout)
        alike = layout.sentences.groupBy(*keys).agg(F.first("paragraph_coords", ignorenulls=True).alias("coords"))
        rows = para.join(placed(alike, keys), keys)
        out.append(_chunk(rows, "paragraph", F.concat(named(12), F.lit("_p"), F.col("paragraph").cast("string")), *about, least))
    if "section" in strategies:
        rows = _alone(section_texts(layout)).join(names, ["doc", "section"]).join(layout.sections.select("doc", "section", "coords"), ["doc", "section"])
        out.append(_chunk(rows, "section", named(24), *about, least))
    # floats: one pass for the three kinds, each near itself
    told = layout.floats.withColumns({
        "text": F.when((F.col("kind") == "formula") | (F.col("text") != ""), F.col("text")).otherwise(F.col("label")), "citations": none,
        **{k: F.when(F.col("kind") == k, F.struct(F.lit(0.0).alias("d"), F.col("ord").cast("int").alias("ord"), F.col("xml_id").alias("xml_id"))) for k in ("figure", "table")},
    })
    short = F.when(F.col("kind") == "figure", "fig_").when(F.col("kind") == "table", "tab_").otherwise("form_")
    xml_id = F.coalesce("xml_id", F.lit(""))
    out.append(_chunk(told, "", F.concat(short, xml_id), F.initcap("kind"), F.lit(0), xml_id, least).drop("chunk_type").withColumn("chunk_type", F.lower("section_title")))
    whole = out[0]
    for rows in out[1:]:
        whole = whole.unionByName(rows)
    return whole


# --- rows of the parts -----------------------------------------------------------------------------------------------------


def _numbered(kind: str, n: Column) -> Column:
    return F.format_string(f"%s_{kind}_%03d", F.col("doc").cast("string"), n)


def _corners(coords: str = "coords") -> list[Column]:
    b = F.get(boxes(coords), F.lit(0))
    return [b["page"].alias("page"), b["x"].alias("bbox_x0"), b["y"].alias("bbox_y0"), (b["x"] + b["w"]).alias("bbox_x1"), (b["y"] + b["h"]).alias("bbox_y1")]


def _or_null(c: str) -> Column:
    return F.when(F.col(c) != "", F.col(c)).alias(c)


def section_rows(layout: Layout) -> DataFrame:
    """section_id, doc, title, level, n, text (with the sections inside it), word_count, page and corners; sections without text too."""
    rows = layout.sections.join(section_texts(layout).select("doc", "section", "text"), ["doc", "section"], "left")
    words = F.size(F.filter(F.split("text", r"\s+"), lambda w: w != ""))
    return rows.select(_numbered("sec", F.col("section")).alias("section_id"), "doc", _or_null("title"), "level", _or_null("n"), "text", F.coalesce(words, F.lit(0)).alias("word_count"), *_corners())


def figure_rows(layout: Layout) -> DataFrame:
    """figure_id, doc, xml_id, label, caption, page and corners."""
    rows = layout.floats.filter("kind = 'figure'").withColumnRenamed("text", "caption")
    return rows.select(_numbered("fig", F.col("ord")).alias("figure_id"), "doc", _or_null("xml_id"), _or_null("label"), _or_null("caption"), *_corners())


def table_rows(layout: Layout) -> DataFrame:
    """table_id, doc, xml_id, page, label, caption, header_row, row_count, col_count (of the first row) and has_numeric_data."""
    rows = layout.floats.filter("kind = 'table'").withColumnRenamed("text", "caption")
    cells = F.coalesce("cells", F.array().cast("array<array<string>>"))
    head = F.get(cells, F.lit(0))
    numeric = F.exists(F.flatten(cells), lambda c: F.coalesce(c, F.lit("")).rlike(r"\b\d+[.,]?\d*\b"))
    return rows.select(
        _numbered("tbl", F.col("ord")).alias("table_id"), "doc", _or_null("xml_id"), _corners()[0], _or_null("label"), _or_null("caption"), head.alias("header_row"), F.size(cells).alias("row_count"),
        F.coalesce(F.size(head), F.lit(0)).alias("col_count"), F.coalesce(numeric, F.lit(False)).alias("has_numeric_data"),
    )


def equation_rows(layout: Layout) -> DataFrame:
    """equation_id, doc, xml_id, text, page and corners."""
    rows = layout.floats.filter("kind = 'formula'")
    return rows.select(_numbered("eq", F.col("ord")).alias("equation_id"), "doc", _or_null("xml_id"), _or_null("text"), *_corners())


def caption_rows(layout: Layout) -> DataFrame:
    """caption_id, doc, parent_id, parent_type, label, text, page: captions of figures, then of tables, numbered in their document."""
    rows = layout.floats.filter("kind in ('figure', 'table') and text <> ''")
    n = F.row_number().over(Window.partitionBy("doc").orderBy("kind", "ord")) - 1
    parent = F.when(F.col("kind") == "figure", _numbered("fig", F.col("ord"))).otherwise(_numbered("tbl", F.col("ord")))
    return rows.select(_numbered("cap", n).alias("caption_id"), "doc", parent.alias("parent_id"), F.col("kind").alias("parent_type"), _or_null("label"), "text", _corners()[0])
