"""Objects of documents in one table with their types, flags and candidates, what follows what, and one summary for each paper from its tables.

Parts: sections (section_id, doc, title, text, page), figures (figure_id, doc, label, caption, page), tables (table_id, doc, label, caption, header_row, page), equations (equation_id, doc, text, page) and
references (ref_id, doc, raw, title). Defined cases: null texts are empty for rules and stay null as they are; a table without header has no candidate variables; a document with one section has nothing that follows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from .entities import numbered

MOST_TEXT = 2000
# Words that flag a text; those of models and metrics are candidates as well.
SIGNALS = {
    "models": r"\b(?:lstm|swat|vic|hbv|topmodel|sacsma|hec.ras|xgboost|random.forest|gradient.boost|ann|cnn|transformer|bert|gpt|xaj|pdm|tank|simhyd|gr4j|sacramento|hymod|arima)\b",
    "metrics": r"\b(?:nse|kge|rmse|mae|mse|pbias|r[²2]|mape|bias|correlation|cc|kling.gupta)\b",
    "timeseries": r"\b(?:time.series|temporal|hourly|daily|monthly|annual|discharge|streamflow)\b",
    "coordinates": r"\b(?:lat(?:itude)?|lon(?:gitude)?|coord(?:inate)?|utm|georefer|spatial|gis|epsg)\b",
    "satellite": r"\b(?:modis|landsat|sentinel|sar|radar|goes|grace|gpm|trmm|chirps|era5)\b",
    "hydrograph": r"\b(?:hydrograph|discharge|streamflow|runoff|flood|peak.flow|baseflow)\b",
}
# Names of equations, the first that fits.
EQUATIONS = (
    (r"\bnse\b|\bnash.sutcliffe\b", "NSE"), (r"\bkge\b|\bkling.gupta\b", "KGE"), (r"\brmse\b", "RMSE"), (r"\bmae\b", "MAE"), (r"\bpbias\b", "PBIAS"), (r"\bdarcy\b", "Darcy"), (r"\bmanning\b", "Manning"), (r"\bcontinuity\b", "Continuity"),
)


def candidates(text: Column, kind: str) -> Column:
    """The different signals of a kind in a text, in upper case and in order; null without any."""
    found = F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit("(?i)" + SIGNALS[kind]), F.lit(0)), F.upper))
    return F.when(F.size(found) > 0, found)


def _typed(rows: DataFrame, kind: str, id_col: str, typed: Column, flagged: Column | None, raw: Column, equation: Column | None = None, variables: Column | None = None) -> DataFrame:
    flags = [(R.matches(flagged, p) if flagged is not None else F.lit(False)).alias(f"contains_{k}") for k, p in SIGNALS.items()]
    found = [(candidates(flagged, k) if flagged is not None else F.lit(None).cast("array<string>")).alias(f"candidate_{k}") for k in ("models", "metrics")]
    page = F.col("page").cast("int") if "page" in rows.columns else F.lit(None).cast("int")
    none = lambda c, t: (F.lit(None) if c is None else c).cast(t)
    return rows.withColumn("_t", typed).select(
        F.col(id_col).cast("string").alias("object_id"), F.col("doc"), F.lit(kind).alias("object_type"), F.col("_t.label").alias("semantic_type"), F.col("_t.score").alias("classifier_score"), page.alias("page"), raw.alias("raw_text"),
        none(equation, "string").alias("equation_name"), none(variables, "array<string>").alias("candidate_vars"), *flags, *found,
    )


def typed_objects(sections: DataFrame, figures: DataFrame, tables: DataFrame, equations: DataFrame, references: DataFrame) -> DataFrame:
    """All parts as rows of one form: object_id, doc, object_type, semantic_type with its score, page, raw_text, equation_name, candidate_vars, six flags and the candidates. One pass over each part."""
    said = lambda c: F.coalesce(F.col(c), F.lit(""))
    joined = lambda *cs: F.concat_ws(" ", *[F.when(x != "", x) for x in cs])
    caption, header = joined(said("label"), said("caption")), F.array_join(F.coalesce("header_row", F.array().cast("array<string>")), " ")
    table, equation = joined(said("label"), said("caption"), header), F.trim(said("text"))
    always = F.struct(F.lit("reference").alias("label"), F.lit(1.0).alias("score"))
    out = [
        _typed(sections, "section", "section_id", R.first_match(F.trim(said("title")), R.SECTION_RULES, R.SECTION_DEFAULT), said("text"), F.substring(said("text"), 1, MOST_TEXT)),
        _typed(figures, "figure", "figure_id", R.first_match(caption, R.FIGURE_RULES, R.FIGURE_DEFAULT), caption, F.col("caption")),
        _typed(tables, "table", "table_id", R.first_match(table, R.TABLE_RULES, R.TABLE_DEFAULT), table, F.col("caption"), variables=F.when(F.size("header_row") > 0, F.col("header_row"))),
        _typed(equations, "equation", "equation_id", R.first_match(equation, R.EQUATION_RULES, R.EQUATION_DEFAULT), equation, F.col("text"), equation=R.first_label(equation, EQUATIONS)),
        _typed(references, "reference", "ref_id", always, None, F.coalesce(F.when(F.col("raw") != "", F.col("raw")), F.col("title"))),
    ]
    whole = out[0]
    for rows in out[1:]:
        whole = whole.unionByName(rows)
    return whole


def follows(sections: DataFrame) -> DataFrame:
    """sections: section_id, doc, ord. Edges (edge_id, doc, source_id, target_id, relation, confidence) from each section to the next one of its document; very long documents are dealt out in stretches."""
    rows = numbered(sections.select(F.col("section_id").alias("id"), "doc", F.col("ord").cast("long").alias("ord")), "doc", "ord").filter("follows is not null")
    return rows.select(F.concat_ws("_to_", "follows", "id").alias("edge_id"), "doc", F.col("follows").alias("source_id"), F.col("id").alias("target_id"), F.lit("FOLLOWS").alias("relation"), F.lit(1.0).alias("confidence"))


def summaries(papers: DataFrame, facts: DataFrame | None, formulas: DataFrame | None, tables: DataFrame | None, regions: DataFrame | None) -> DataFrame:
    """One row for each paper (paper_id, once): metrics, metric_values, n_facts, formula_classes, n_formulas, n_tables, n_numeric_tables, regions_count, formula_regions, table_regions, has_second_content.

    facts: paper_id, metric, value; formulas: paper_id, formula_class; tables: paper_id, has_numeric_data; regions: paper_id, region_type, latex, text. A table that is None is skipped; what a paper has nothing of is
    null, not zero. metric_values keeps every value, in order, under its metric; facts without a metric count only, and metrics without values have none.
    """
    out, said = papers.select("paper_id").distinct(), lambda c: F.coalesce(F.col(c) != "", F.lit(False))
    nothing = {}
    if facts is not None:
        values = F.array_sort(F.collect_list("value"))
        per = facts.groupBy("paper_id", F.when(F.col("metric") != "", F.col("metric")).alias("metric")).agg(values.alias("v"), F.count(F.lit(1)).alias("n"))
        named = F.array_sort(F.collect_list(F.when(F.col("metric").isNotNull(), F.struct("metric", "v"))))
        out = out.join(per.groupBy("paper_id").agg(named.alias("_m"), F.sum("n").alias("n_facts")), "paper_id", "left").withColumns({"metrics": F.col("_m.metric"), "metric_values": F.map_from_entries("_m")}).drop("_m")
    else:
        nothing |= {"metrics": "array<string>", "metric_values": "map<string,array<double>>", "n_facts": "bigint"}
    if formulas is not None:
        out = out.join(formulas.groupBy("paper_id").agg(F.array_sort(F.collect_set("formula_class")).alias("formula_classes"), F.count(F.lit(1)).alias("n_formulas")), "paper_id", "left")
    else:
        nothing |= {"formula_classes": "array<string>", "n_formulas": "bigint"}
    if tables is not None:
        out = out.join(tables.groupBy("paper_id").agg(F.count(F.lit(1)).alias("n_tables"), F.count_if("has_numeric_data").alias("n_numeric_tables")), "paper_id", "left")
    else:
        nothing |= {"n_tables": "bigint", "n_numeric_tables": "bigint"}
    if regions is not None:
        kind = lambda k: F.count_if(F.col("region_type") == k)
        per = regions.groupBy("paper_id").agg(F.count(F.lit(1)).alias("regions_count"), kind("FORMULA_REGION").alias("formula_regions"), kind("TABLE_REGION").alias("table_regions"), F.bool_or(said("latex") | said("text")).alias("has_second_content"))
        out = out.join(per, "paper_id", "left")
    else:
        nothing |= {"regions_count": "bigint", "formula_regions": "bigint", "table_regions": "bigint", "has_second_content": "boolean"}
    out = out.withColumns({k: F.lit(None).cast(t) for k, t in nothing.items()}) if nothing else out
    return out.select("paper_id", "metrics", "metric_values", "n_facts", "formula_classes", "n_formulas", "n_tables", "n_numeric_tables", "regions_count", "formula_regions", "table_regions", "has_second_content")
