"""How a parsed document is judged and which parsers it goes to; whether stored tables conform to what they should be.

Parses: doc, title, abstract (texts), sections (with text), all_sections, references, citations, boxes, formulas, tables, figures (counts; null: none), has_second (whether a text of the second parser is there).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What counts for a document's quality, and from which score its parse is good enough to be used or to stand alone.
WEIGHTS = {"title": 0.15, "abstract": 0.10, "structure": 0.20, "three_sections": 0.10, "references": 0.15, "citations": 0.10, "coordinates": 0.10, "floats": 0.10}
USABLE_FROM, ALONE_FROM = 0.2, 0.4
STRATEGIES = ("auto", "grobid_only", "nougat_only", "hybrid", "grobid_with_nougat_fallback")


def document_quality(parses: DataFrame) -> DataFrame:
    """doc, what it has (has_structure, has_coordinates, has_references, has_citations, has_formulas, has_tables, has_figures, has_ocr_text), quality_score, usable and needs_second."""
    some = lambda c, least=1: F.coalesce(F.col(c) >= least, F.lit(False))
    said = lambda c: F.coalesce(F.col(c) != "", F.lit(False))
    is_ = {"title": said("title"), "abstract": said("abstract"), "structure": some("sections"), "three_sections": some("all_sections", 3), "references": some("references"), "citations": some("citations"), "coordinates": some("boxes"), "floats": some("figures") | some("tables")}
    score = F.round(sum((F.when(is_[k], w).otherwise(0.0) for k, w in WEIGHTS.items()), F.lit(0.0)), 3)
    rows = parses.select(
        "doc", is_["structure"].alias("has_structure"), is_["coordinates"].alias("has_coordinates"), is_["references"].alias("has_references"), is_["citations"].alias("has_citations"), some("formulas").alias("has_formulas"), some("tables").alias("has_tables"),
        some("figures").alias("has_figures"), F.coalesce("has_second", F.lit(False)).alias("has_ocr_text"), score.alias("quality_score"),
    )
    return rows.withColumn("usable", F.col("has_structure") & (F.col("quality_score") >= USABLE_FROM)).withColumn("needs_second", F.col("quality_score") < ALONE_FROM)


def routed(documents: DataFrame, strategy: Column | str, augment: bool = True) -> DataFrame:
    """documents: doc, parsed (whether the first parser's output is there), scanned, has_text (null: false, true) and usable. Adds route (first, second, both, none) and reason.

    strategy: one of STRATEGIES, or a column of them; an unknown name is refused, in a column it gives no route. augment: whether usable parses are given the second parser's formulas, too.
    """
    if isinstance(strategy, str):
        if strategy not in STRATEGIES:
            raise ValueError(f"unknown strategy: {strategy}")
        strategy = F.lit(strategy)
    parsed, usable = F.coalesce("parsed", F.lit(False)), F.coalesce("usable", F.lit(False))
    scanned = F.coalesce("scanned", F.lit(False)) | ~F.coalesce("has_text", F.lit(True))
    falls = strategy.isin("auto", "grobid_with_nougat_fallback")
    told = lambda route, reason: F.struct(F.lit(route).alias("route"), F.lit(reason).alias("reason"))
    choice = (
        F.when(strategy == "nougat_only", told("second", "asked for")).when((strategy == "grobid_only") & parsed, told("first", "asked for")).when(strategy == "grobid_only", told("none", "not parsed")).when(strategy == "hybrid", told("both", "asked for"))
        .when((strategy == "auto") & scanned, told("second", "no text to parse")).when(falls & ~parsed, told("both", "not parsed")).when(falls & ~usable, told("both", "weak parse"))
        .when(falls & F.lit(augment), told("both", "formulas added")).when(falls, told("first", "good parse"))
    )
    return documents.withColumn("_c", choice).withColumns({"route": F.col("_c.route"), "reason": F.col("_c.reason")}).drop("_c")


def conformance(tables: Mapping[str, DataFrame | None], schemas: Mapping[str, T.StructType], ids: Mapping[str, Sequence[str]] | None = None, wanted: Sequence[str] = ()) -> DataFrame:
    """(tab, level, issue, col, n) of tables that are not what schemas say; those in order give one row, level 'ok', with their number of rows.

    Errors: absent (no table, or one that is None), missing column, unexpected column, type. Warnings: empty (a table of `wanted` without rows) and null ids (columns of `ids`), counted; all columns of a table
    are counted in one scan, and schemas are compared without any.
    """
    spark = next(df for df in tables.values() if df is not None).sparkSession
    told, out = [], []
    for name, schema in schemas.items():
        df = tables.get(name)
        if df is None:
            told.append((name, "error", "absent", None, None))
            continue
        have, want = {f.name: f.dataType for f in df.schema}, {f.name: f.dataType for f in schema}
        wrong = [(name, "error", "missing column", c, None) for c in want if c not in have] + [(name, "error", "unexpected column", c, None) for c in have if c not in want]
        wrong += [(name, "error", f"type {have[c].simpleString()} for {t.simpleString()}", c, None) for c, t in want.items() if c in have and have[c] != t]
        told += wrong
        checked = [c for c in (ids or {}).get(name, ()) if c in have]
        counted = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"_{k}") for k, c in enumerate(checked)])
        row = lambda level, issue, col, n: F.struct(F.lit(level).alias("level"), F.lit(issue).alias("issue"), F.lit(col).cast("string").alias("col"), n.cast("long").alias("n"))
        rows = [F.when(F.lit(not wrong), row("ok", "rows", None, F.col("n"))), F.when((F.col("n") == 0) & F.lit(name in wanted), row("warning", "empty", None, F.lit(0))), *[F.when(F.col(f"_{k}") > 0, row("warning", "null ids", c, F.col(f"_{k}"))) for k, c in enumerate(checked)]]
        out.append(counted.select(F.lit(name).alias("tab"), F.explode(F.array_compact(F.array(*rows))).alias("r")).select("tab", "r.*"))
    whole = spark.createDataFrame(told, "tab string, level string, issue string, col string, n long")
    for more in out:
        whole = whole.unionByName(more)
    return whole
