"""Markdown documents as tables of blocks and sections, in DataFrame functions.

A document's lines are told apart by their marks: headings, formulas between $$ or \\[ \\], rows of pipe tables, and text. What runs over several lines (a formula, a table) is found by
windows over the lines of one document. Defined cases: null text has one empty line; a document without headings is one section without title; an open formula ends with the document;
repeated document ids share their lines, so ids are to be unique; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import sentences as sentences_of

HEADING = r"^(#{1,6})\s+(.*?)\s*$"
REFERENCES = r"(?i)^(references|bibliography|literature)"


def lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, i, line, kind (heading, math, table, blank, text), level and block (lines of one formula or table have the same)."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.posexplode(F.split(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), "\n")).alias("i", "line"))
    order = Window.partitionBy("doc_id").orderBy("i")
    bare = F.trim("line")
    marks = F.regexp_count("line", F.lit(r"\$\$")) % 2 + F.when(bare.startswith("\\["), 1).otherwise(0) + F.when(bare.endswith("\\]"), 1).otherwise(0)
    rows = rows.withColumn("_upto", F.sum(marks).over(order)).withColumn("_own", marks)
    inside = ((F.col("_upto") - F.col("_own")) % 2 == 1) | (F.col("_own") % 2 == 1) | F.col("line").contains("$$") | (bare.startswith("\\[") & bare.endswith("\\]"))
    kind = F.when(inside, "math").when(F.col("line").rlike(HEADING), "heading").when(bare.startswith("|") & bare.endswith("|") & (F.length(bare) > 1), "table").when(bare == "", "blank").otherwise("text")
    rows = rows.withColumn("kind", kind)
    starts = (F.col("kind") != F.lag("kind").over(order)) | F.lag("kind").over(order).isNull() | ((F.col("kind") == "math") & ((F.col("_upto") - F.col("_own")) % 2 == 0))
    level = F.when(F.col("kind") == "heading", F.length(F.regexp_extract("line", HEADING, 1)))
    return rows.withColumn("block", F.sum(starts.cast("int")).over(order)).select("doc_id", "i", "line", "kind", level.alias("level"), "block")


def sections(lined: DataFrame) -> DataFrame:
    """doc_id, ord, level, title, parent (ord of the section it lies in), n_lines of text, n_formulas, n_tables; section 0 is what stands before the first heading."""
    order = Window.partitionBy("doc_id").orderBy("i")
    rows = lined.withColumn("ord", F.sum((F.col("kind") == "heading").cast("int")).over(order))
    title = F.max(F.when(F.col("kind") == "heading", F.regexp_extract("line", HEADING, 2)))
    per = rows.groupBy("doc_id", "ord").agg(
        F.max("level").alias("level"), title.alias("title"), F.count_if(F.col("kind") == "text").alias("n_lines"),
        F.count_distinct(F.when(F.col("kind") == "math", F.col("block"))).alias("n_formulas"), F.count_distinct(F.when(F.col("kind") == "table", F.col("block"))).alias("n_tables"),
    )
    # the nearest section before it of a lower level
    before = Window.partitionBy("doc_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    parents = F.coalesce(*[F.lit(None).cast("int")], F.greatest(*[F.when(F.col("level") > k, F.max(F.when(F.col("level") == k, F.col("ord"))).over(before)) for k in range(1, 6)], F.lit(None).cast("long")))
    return per.withColumn("parent", parents).filter((F.col("ord") > 0) | (F.col("n_lines") + F.col("n_formulas") + F.col("n_tables") > 0))


def sentences(lined: DataFrame) -> DataFrame:
    """doc_id, ord (the section's), paragraph (from 0 in the section), place (from 0 in the paragraph), sentence: lines of text up to a blank line, a heading, a formula or a table are one paragraph.

    Lines are put together with a blank between them; stretches without a letter or digit are no sentences."""
    order = Window.partitionBy("doc_id").orderBy("i")
    rows = lined.withColumn("ord", F.sum((F.col("kind") == "heading").cast("int")).over(order)).filter("kind = 'text'")
    per = rows.groupBy("doc_id", "ord", "block").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", F.trim("line").alias("s")))), lambda x: x["s"]), " ").alias("text"))
    numbered = per.withColumn("paragraph", F.row_number().over(Window.partitionBy("doc_id", "ord").orderBy("block")) - 1)
    cut = numbered.select("doc_id", "ord", "paragraph", F.posexplode(F.filter(sentences_of(F.col("text")), lambda s: s.rlike(r"[\p{L}\p{N}]"))).alias("place", "sentence"))
    return cut.select("doc_id", "ord", "paragraph", "place", F.trim("sentence").alias("sentence"))


def table_cells(lined: DataFrame) -> DataFrame:
    """table_id (doc_id and block), row_no and cells of pipe tables, without the line under the header; as operators.tables reads them."""
    rows = lined.filter("kind = 'table'").filter(~F.trim("line").rlike(r"^\|[\s:|-]+\|$"))
    at = Window.partitionBy("doc_id", "block").orderBy("i")
    cells = F.transform(F.split(F.regexp_replace(F.trim("line"), r"^\||\|$", ""), r"\|"), lambda c: F.trim(c))
    return rows.select(F.concat_ws(":", "doc_id", "block").alias("table_id"), (F.row_number().over(at) - 1).alias("row_no"), cells.alias("cells"))


def references(lined: DataFrame) -> DataFrame:
    """doc_id, ref (its text) and key of the entries of sections called references: by DOI, else by the title without signs; of equal keys in a document the first stays."""
    order = Window.partitionBy("doc_id").orderBy("i")
    heading = F.when(F.col("kind") == "heading", F.regexp_extract("line", HEADING, 2))
    rows = lined.withColumn("_in", F.last(heading, ignorenulls=True).over(order)).filter((F.col("kind") == "text") & F.col("_in").rlike(REFERENCES))
    doi = F.lower(F.regexp_extract("line", r"(10\.\d{4,9}/[^\s,;]+)", 1))
    squeezed = F.regexp_replace(F.lower("line"), "[^a-z0-9]+", "")
    rows = rows.select("doc_id", "i", F.trim("line").alias("ref"), F.when(doi != "", F.concat(F.lit("doi:"), doi)).otherwise(F.concat(F.lit("title:"), squeezed)).alias("key"))
    return rows.groupBy("doc_id", "key").agg(F.min_by("ref", "i").alias("ref"), F.count("*").alias("n"))
