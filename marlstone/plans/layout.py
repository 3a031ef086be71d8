"""Queries on documents with a layout. The texts of `documents` are laid out by their lines: a line is a paragraph, three are a section, eight a page, with figures, tables and formulas among them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import layout as L
from ..operators import regions as R
from .registry import Tables, query


def layout(t: Tables) -> L.Layout:
    c = F.col
    s = lambda x: x.cast("string")
    lines = t.documents.select(c("doc_id").alias("doc"), F.posexplode(F.split("text", "\n")).alias("i", "line"))
    section, page = F.floor(c("i") / 3).cast("int"), F.floor(c("i") / 8).cast("int") + 1
    sections = lines.filter("i % 3 = 0").select(
        "doc", section.alias("section"), F.concat(F.lit("Title of part "), s(section)).alias("title"), (section % 3 + 1).alias("level"), F.when(section % 2 == 0, s(section + 1)).otherwise("").alias("n"),
        F.concat_ws(",", s(page), F.lit("40,10,300,400")).alias("coords"),
    )
    cut = lines.select("doc", "i", F.posexplode(F.split("line", r"(?<=[.!?])\s+")).alias("j", "text"))
    box = F.concat_ws(",", s(page), s(c("j") * 7 + 40), s(c("i") % 8 * 80 + c("j") * 10), F.lit("100,10"))
    turned = F.when(c("j") % 4 == 0, F.concat_ws(",", s(page + 1), F.lit("40,20,100,10")))
    sentences = cut.select(
        "doc", section.alias("section"), (c("i") % 3).alias("paragraph"), c("j").alias("place"), "text", F.when(c("j") % 3 == 0, F.array(F.concat(F.lit("b"), s(c("i"))))).otherwise(F.array().cast("array<string>")).alias("citations"),
        F.when((c("i") + c("j")) % 7 != 0, F.concat_ws(";", box, F.lit("no box"), turned)).alias("coords"), F.concat_ws(",", s(page), F.lit("40"), s(c("i") % 8 * 80), F.lit("200,60")).alias("paragraph_coords"),
    )

    def floats(kind: str, every: int, at: int, x: int, down: int, text, cells=None) -> DataFrame:
        coords = F.concat_ws(",", s(page), F.lit(str(x)), s(c("i") % 8 * 80 + down), F.lit("120,60"))
        label = F.concat(F.initcap(F.lit(kind)), F.lit(" "), s(c("i")))
        rows = lines.filter(c("i") % every == at)
        cells = F.lit(None) if cells is None else cells
        return rows.select("doc", F.lit(kind).alias("kind"), F.floor(c("i") / every).cast("int").alias("ord"), F.concat(F.lit(kind[:3]), s(c("i"))).alias("xml_id"), label.alias("label"), text.alias("text"), coords.alias("coords"), cells.cast("array<array<string>>").alias("cells"))

    grid = F.array(F.array(F.lit("Site"), F.lit("Score")), F.when(c("i") % 2 == 0, F.array(F.lit("one"), s(c("i")))).otherwise(F.array(F.lit("two"), F.lit("good"))))
    whole = (
        floats("figure", 4, 1, 300, 0, F.when(c("i") % 8 == 1, F.concat(F.lit("A map of the places of line "), s(c("i")))).otherwise(""))
        .unionByName(floats("table", 5, 2, 60, 40, F.concat(F.lit("Scores of all sites of line "), s(c("i"))), grid))
        .unionByName(floats("formula", 6, 3, 60, 20, F.concat(F.lit("y = a * x + b of line "), s(c("i")))))
    )
    return L.Layout(sections, sentences, whole, lines.filter("i = 0").select("doc", F.col("line").alias("text")))


_LINES = "l AS (SELECT doc_id AS doc, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents)"
_FLOATS = """f AS (SELECT doc, 'figure' AS kind, i // 4 AS ord, 'fig' || i AS xml_id, 'Figure ' || i AS label, CASE WHEN i % 8 = 1 THEN 'A map of the places of line ' || i ELSE '' END AS text, i // 8 + 1 AS page, 300.0::DOUBLE AS x, (i % 8 * 80)::DOUBLE AS y, i FROM l WHERE i % 4 = 1
    UNION ALL SELECT doc, 'table', i // 5, 'tab' || i, 'Table ' || i, 'Scores of all sites of line ' || i, i // 8 + 1, 60.0, i % 8 * 80 + 40, i FROM l WHERE i % 5 = 2
    UNION ALL SELECT doc, 'formula', i // 6, 'for' || i, 'Formula ' || i, 'y = a * x + b of line ' || i, i // 8 + 1, 60.0, i % 8 * 80 + 20, i FROM l WHERE i % 6 = 3)"""
_BODY = f"""{_LINES}, {_FLOATS}, sec AS (SELECT doc, i // 3 AS section, 'Title of part ' || (i // 3) AS title, i // 3 % 3 + 1 AS level, CASE WHEN i // 3 % 2 = 0 THEN (i // 3 + 1)::VARCHAR ELSE '' END AS n, i // 8 + 1 AS page FROM l WHERE i % 3 = 0),
    cut AS (SELECT doc, i, string_split(regexp_replace(line, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)) AS parts FROM l), st AS (SELECT doc, i, unnest(parts) AS text, generate_subscripts(parts, 1) - 1 AS j FROM cut),
    pr AS (SELECT doc, i, i // 3 AS section, string_agg(text, ' ' ORDER BY j) AS text, list('b' || i ORDER BY j) FILTER (WHERE j % 3 = 0) AS citations FROM st GROUP BY ALL),
    ends AS (SELECT a.doc, a.section, min(b.section) AS upto FROM sec a LEFT JOIN sec b ON a.doc = b.doc AND b.section > a.section AND b.level <= a.level GROUP BY ALL),
    sx AS (SELECT e.doc, e.section, string_agg(p.text, chr(10) || chr(10) ORDER BY p.i) AS text, flatten(list(p.citations ORDER BY p.i)) AS citations FROM ends e JOIN pr p ON p.doc = e.doc AND p.section >= e.section AND (e.upto IS NULL OR p.section < e.upto) WHERE p.text <> '' GROUP BY ALL)"""


def _near(source: str, keys: str) -> str:
    """The nearest float of each kind to the boxes of a table of keys, page, cx and cy."""
    return f"""SELECT {keys}, arg_min(xml_id, (d, ord)) FILTER (WHERE kind = 'figure') AS figure_id, arg_min(xml_id, (d, ord)) FILTER (WHERE kind = 'table') AS table_id FROM
        (SELECT b.*, f.kind, f.ord, f.xml_id, (b.cx - f.x - 60) ** 2 + (b.cy - f.y - 30) ** 2 AS d FROM {source} b JOIN f ON f.doc = b.doc AND f.page = b.page AND f.kind <> 'formula') WHERE d <= 22500 GROUP BY ALL"""


_ID = "substr(sha1(substr(doc::VARCHAR, 1, 16) || ':' || {}), 1, 20)"


@query(
    "E2 E3 J13 J14",
    f"""WITH {_BODY}, sb AS (SELECT doc, i, j, i // 8 + 1 AS page, 90.0 + 7 * j AS cx, i % 8 * 80 + 10 * j + 5.0 AS cy FROM st WHERE (i + j) % 7 <> 0 UNION ALL SELECT doc, i, j, i // 8 + 2, 90.0, 25.0 FROM st WHERE (i + j) % 7 <> 0 AND j % 4 = 0),
        pb AS (SELECT doc, i, i // 8 + 1 AS page, 140.0 AS cx, i % 8 * 80 + 30.0 AS cy FROM pr), sn AS ({_near('sb', 'doc, i, j')}), pn AS ({_near('pb', 'doc, i')}),
        c AS (SELECT doc, 'abstract' AS chunk_type, 'abstract' AS key, line AS text, 'Abstract' AS section_title, 0 AS section_level, '' AS section_n, 1 AS page, NULL::DOUBLE AS x, NULL::DOUBLE AS y, NULL AS figure_id, NULL AS table_id, []::VARCHAR[] AS citations FROM l WHERE i = 0
        UNION ALL SELECT doc, 'sentence', concat_ws('_', CASE WHEN n <> '' THEN n ELSE substr(title, 1, 12) END, j::VARCHAR, substr(sha1(text), 1, 8)), text, title, level, n, CASE WHEN (i + j) % 7 <> 0 THEN i // 8 + 1 ELSE 0 END, CASE WHEN (i + j) % 7 <> 0 THEN 40 + 7 * j END, CASE WHEN (i + j) % 7 <> 0 THEN i % 8 * 80 + 10 * j END,
            figure_id, table_id, CASE WHEN j % 3 = 0 THEN ['b' || i] ELSE [] END FROM (SELECT *, i // 3 AS section FROM st) st JOIN sec USING (doc, section) LEFT JOIN sn USING (doc, i, j)
        UNION ALL SELECT doc, 'paragraph', CASE WHEN n <> '' THEN n ELSE substr(title, 1, 12) END || '_p' || (i % 3), text, title, level, n, i // 8 + 1, 40, i % 8 * 80, figure_id, table_id, citations FROM pr JOIN sec USING (doc, section) LEFT JOIN pn USING (doc, i)
        UNION ALL SELECT doc, 'section', CASE WHEN n <> '' THEN n ELSE substr(title, 1, 24) END, text, title, level, n, page, 40, 10, NULL, NULL, citations FROM sx JOIN sec USING (doc, section)
        UNION ALL SELECT doc, kind, CASE kind WHEN 'figure' THEN 'fig_' WHEN 'table' THEN 'tab_' ELSE 'form_' END || xml_id, CASE WHEN text <> '' THEN text ELSE label END, upper(kind[1]) || kind[2:], 0, xml_id, page, x, y, CASE kind WHEN 'figure' THEN xml_id END, CASE kind WHEN 'table' THEN xml_id END, [] FROM f)
        SELECT {_ID.format('key')} AS chunk_id, doc, chunk_type, md5(text) AS digest, section_title, section_level::INT AS section_level, section_n, page::INT AS page, x::DOUBLE AS x, y::DOUBLE AS y, figure_id IS NOT NULL AS near_figure, figure_id, table_id IS NOT NULL AS near_table, table_id, array_to_string(citations, ',') AS citations FROM c WHERE length(text) >= 20""",
)
def e_chunks_of_all_kinds(t: Tables) -> DataFrame:
    """Abstracts, sentences, paragraphs, sections, figures, tables and formulas as chunks with their place, citations and what stands near them."""
    rows = L.chunks(layout(t), ("sentence", "paragraph", "section"))
    return rows.select("chunk_id", "doc", "chunk_type", F.md5("text").alias("digest"), "section_title", "section_level", "section_n", "page", "x", "y", "near_figure", "figure_id", "near_table", "table_id", F.array_join("citations", ",").alias("citations"))


@query(
    "E38 E3",
    f"""WITH {_BODY} SELECT doc || '_sec_' || lpad(section::VARCHAR, greatest(3, length(section::VARCHAR))::INT, '0') AS section_id, doc, title, level::INT AS level, CASE WHEN n <> '' THEN n END AS n, md5(text) AS digest,
        coalesce(len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')), 0)::INT AS word_count, page::INT AS page, 40.0::DOUBLE AS bbox_x0, 410.0::DOUBLE AS bbox_y1 FROM sec LEFT JOIN sx USING (doc, section)""",
)
def e_section_rows(t: Tables) -> DataFrame:
    """Sections as rows, with the texts of the sections inside them."""
    rows = L.section_rows(layout(t))
    return rows.select("section_id", "doc", "title", "level", "n", F.md5("text").alias("digest"), "word_count", "page", "bbox_x0", "bbox_y1")


_OF = "doc || '_{}_' || lpad({}::VARCHAR, greatest(3, length({}::VARCHAR))::INT, '0')"


@query(
    "E38",
    f"""WITH {_LINES}, {_FLOATS} SELECT {_OF.format('fig', 'ord', 'ord')} AS row_id, kind, xml_id, label, CASE WHEN text <> '' THEN text END AS text, page::INT AS page, x + 120 AS right_edge, NULL AS header, NULL AS n_rows, NULL AS numeric FROM f WHERE kind = 'figure'
        UNION ALL SELECT {_OF.format('eq', 'ord', 'ord')}, kind, xml_id, NULL, text, page, x + 120, NULL, NULL, NULL FROM f WHERE kind = 'formula'
        UNION ALL SELECT {_OF.format('tbl', 'ord', 'ord')}, kind, xml_id, label, text, page, NULL, 'Site,Score', 2, i % 2 = 0 FROM f WHERE kind = 'table'""",
)
def e_float_rows(t: Tables) -> DataFrame:
    """Figures, equations and tables as rows of one form."""
    laid = layout(t)
    none = lambda kind: F.lit(None).cast(kind)
    figures = L.figure_rows(laid).select(F.col("figure_id").alias("row_id"), F.lit("figure").alias("kind"), "xml_id", "label", F.col("caption").alias("text"), "page", F.col("bbox_x1").alias("right_edge"), none("string").alias("header"), none("int").alias("n_rows"), none("boolean").alias("numeric"))
    equations = L.equation_rows(laid).select(F.col("equation_id").alias("row_id"), F.lit("formula").alias("kind"), "xml_id", none("string").alias("label"), "text", "page", F.col("bbox_x1").alias("right_edge"), none("string").alias("header"), none("int").alias("n_rows"), none("boolean").alias("numeric"))
    tables = L.table_rows(laid).select(F.col("table_id").alias("row_id"), F.lit("table").alias("kind"), "xml_id", "label", F.col("caption").alias("text"), "page", none("double").alias("right_edge"), F.array_join("header_row", ",").alias("header"), F.col("row_count").alias("n_rows"), F.col("has_numeric_data").alias("numeric"))
    return figures.unionByName(equations).unionByName(tables)


@query(
    "E38 W1",
    f"""WITH {_LINES}, {_FLOATS}, c AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY kind, ord) - 1 AS k FROM f WHERE kind <> 'formula' AND text <> '')
        SELECT {_OF.format('cap', 'k', 'k')} AS caption_id, doc, CASE kind WHEN 'figure' THEN {_OF.format('fig', 'ord', 'ord')} ELSE {_OF.format('tbl', 'ord', 'ord')} END AS parent_id, kind AS parent_type, label, text, page::INT AS page FROM c""",
)
def e_caption_rows(t: Tables) -> DataFrame:
    """Captions of figures and tables with the row that they belong to."""
    return L.caption_rows(layout(t))


def blocks(t: Tables) -> DataFrame:
    """Blocks of the pages of customers: each order is one, placed and told apart by its key."""
    k = F.col("o_orderkey")
    roles = F.array(*map(F.lit, ("figure", "graphic", "table", "formula", "caption", "table_head", "context", "graphic", "label")))
    x, y = (k * 13 % 450).cast("double"), (k * 31 % 750).cast("double")
    return t.orders.select(
        F.col("o_custkey").alias("doc"), (k % 2 + 1).cast("int").alias("page"), k.alias("id"), F.element_at(roles, (k % 9 + 1).cast("int")).alias("role"),
        F.when(k % 9 == 4, F.concat(F.lit("Figure with a map "), k.cast("string"))).otherwise(F.concat(F.lit("text "), k.cast("string"))).alias("text"), x.alias("x0"), y.alias("y0"), (x + 20 + k % 130).alias("x1"), (y + 15 + k % 80).alias("y1"),
    )


@query("E21 J16")
def e_regions(t: Tables) -> DataFrame:
    """Regions of pages with their captions; merged by families in rounds, so without SQL. Tested against a plain version."""
    return R.regions(blocks(t)).withColumn("blocks", F.array_join("blocks", ","))
