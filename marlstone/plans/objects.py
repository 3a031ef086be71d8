"""Queries on typed objects of documents, their order, and summaries of papers. Captions and titles are put together from words by a part's key, the same in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..operators import objects as O
from .classes import TITLES, first_rule_sql
from .phrases import phrase, phrase_sql, quoted
from .registry import Tables, query

WORDS = ("an LSTM", "the SWAT", "by NSE and kge", "R2", "hourly", "at latitude", "Sentinel data", "peak flow", "Manning", "lstm again", "plain words", "random forest", "RMSE", "of Darcy", "bar chart", "comparing", "gauges at", "a workflow", "Kling-Gupta")
_CAPTION, _BODY, _TITLE = ((7, 1), (11, 3), (13, 5)), ((3, 2), (5, 1), (9, 4), (8, 7)), ((3, 2),)
_PARTS = f"""w AS (SELECT p_partkey AS k, p_partkey // 6 AS doc, CASE WHEN p_partkey % 9 > 0 THEN {phrase_sql('p_partkey', WORDS, _CAPTION)} END AS caption, {phrase_sql('p_partkey', WORDS, _BODY)} AS body, {phrase_sql('p_partkey', TITLES, _TITLE)} AS title, p_partkey % 6 AS kind, p_size FROM part),
    x AS (SELECT k, doc, CASE kind WHEN 0 THEN 'section' WHEN 1 THEN 'section' WHEN 2 THEN 'figure' WHEN 3 THEN 'table' WHEN 4 THEN 'equation' ELSE 'reference' END AS object_type, CASE kind WHEN 0 THEN title WHEN 1 THEN title WHEN 2 THEN concat_ws(' ', 'Figure ' || p_size, nullif(caption, ''))
            WHEN 3 THEN concat_ws(' ', 'Table ' || p_size, caption, CASE WHEN k % 4 = 1 THEN 'Site NSE' END) WHEN 4 THEN coalesce(caption, '') ELSE '' END AS told,
            CASE kind WHEN 0 THEN body WHEN 1 THEN body WHEN 2 THEN concat_ws(' ', 'Figure ' || p_size, caption) WHEN 3 THEN concat_ws(' ', 'Table ' || p_size, caption, CASE WHEN k % 4 = 1 THEN 'Site NSE' END) WHEN 4 THEN coalesce(caption, '') END AS flagged,
            CASE WHEN kind < 2 THEN body WHEN kind < 5 THEN caption ELSE coalesce(caption, title) END AS raw, p_size AS page FROM w)"""
_RULES = {"section": (R.SECTION_RULES, R.SECTION_DEFAULT), "figure": (R.FIGURE_RULES, R.FIGURE_DEFAULT), "table": (R.TABLE_RULES, R.TABLE_DEFAULT), "equation": (R.EQUATION_RULES, R.EQUATION_DEFAULT)}
_TYPES = " UNION ALL ".join(f"({first_rule_sql('k', f'(SELECT * FROM x WHERE object_type = {quoted(kind)})', 'told', rules, default)})" for kind, (rules, default) in _RULES.items())
_found = lambda k: f"CASE WHEN regexp_matches(flagged, {quoted('(?i)' + O.SIGNALS[k])}) THEN (SELECT string_agg(u, ',' ORDER BY i) FROM (SELECT upper(v) AS u, min(i) AS i FROM (SELECT unnest(regexp_extract_all(flagged, {quoted('(?i)' + O.SIGNALS[k])})) AS v, unnest(range(1, 99)) AS i) WHERE v IS NOT NULL GROUP BY 1)) END"
_EQUATION = "CASE WHEN object_type = 'equation' THEN CASE " + " ".join(f"WHEN regexp_matches(flagged, {quoted('(?i)' + p)}) THEN {quoted(n)}" for p, n in O.EQUATIONS) + " END END"


def _parts(t: Tables) -> list[DataFrame]:
    k, size = F.col("p_partkey"), F.col("p_size").cast("string")
    caption = F.when(k % 9 > 0, phrase(k, WORDS, _CAPTION))
    rows = t.part.select(k.alias("k"), F.floor(k / 6).alias("doc"), caption.alias("caption"), phrase(k, WORDS, _BODY).alias("body"), phrase(k, TITLES, _TITLE).alias("title"), (k % 6).alias("kind"), F.concat(F.lit("Figure "), size).alias("_f"), F.concat(F.lit("Table "), size).alias("_t"), F.col("p_size").alias("page"))
    c = F.col
    return [
        rows.filter("kind < 2").select(c("k").alias("section_id"), "doc", "title", c("body").alias("text"), "page", c("k").alias("ord")),
        rows.filter("kind = 2").select(c("k").alias("figure_id"), "doc", c("_f").alias("label"), "caption", "page"),
        rows.filter("kind = 3").select(c("k").alias("table_id"), "doc", c("_t").alias("label"), "caption", F.when(c("k") % 4 == 1, F.array(F.lit("Site"), F.lit("NSE"))).otherwise(F.array().cast("array<string>")).alias("header_row"), "page"),
        rows.filter("kind = 4").select(c("k").alias("equation_id"), "doc", c("caption").alias("text"), "page"),
        rows.filter("kind = 5").select(c("k").alias("ref_id"), "doc", c("caption").alias("raw"), "title"),
    ]


@query(
    "E24 C11",
    f"""WITH {_PARTS}, s AS ({_TYPES}) SELECT k::VARCHAR AS object_id, doc, object_type, coalesce(label, 'reference') AS semantic_type, coalesce(score, 1.0)::DOUBLE AS classifier_score, CASE WHEN object_type <> 'reference' THEN page END::INT AS page, raw AS raw_text, {_EQUATION} AS equation_name,
        CASE WHEN object_type = 'table' AND k % 4 = 1 THEN 'Site,NSE' END AS candidate_vars, {', '.join(f"coalesce(regexp_matches(flagged, {quoted('(?i)' + p)}), false) AS contains_{n}" for n, p in O.SIGNALS.items())}, {_found('models')} AS candidate_models, {_found('metrics')} AS candidate_metrics FROM x LEFT JOIN s USING (k)""",
)
def e_objects(t: Tables) -> DataFrame:
    """Sections, figures, tables, equations and references as objects of one form, with types, flags and candidates."""
    rows = O.typed_objects(*_parts(t))
    return rows.withColumns({f"candidate_{k}": F.array_join(f"candidate_{k}", ",") for k in ("vars", "models", "metrics")})


@query("E24 W5", f"WITH {_PARTS}, f AS (SELECT k, doc, lag(k) OVER (PARTITION BY doc ORDER BY k) AS p FROM x WHERE object_type = 'section') SELECT p || '_to_' || k AS edge_id, doc, p AS source_id, k AS target_id, 'FOLLOWS' AS relation, 1.0::DOUBLE AS confidence FROM f WHERE p IS NOT NULL")
def e_section_order(t: Tables) -> DataFrame:
    """Edges from each section to the next one of its document."""
    return O.follows(_parts(t)[0])


_METRICS = ("NSE", "", "RMSE", "KGE")


@query(
    "E42 A12",
    f"""WITH f AS (SELECT l_orderkey AS paper_id, [{', '.join(map(quoted, _METRICS))}][l_linenumber % 4 + 1] AS metric, CASE WHEN l_partkey % 5 > 0 THEN l_discount END AS value FROM lineitem WHERE l_orderkey % 7 > 0), v AS (SELECT paper_id, metric, count(*) AS n, coalesce(string_agg(round(value * 100)::BIGINT::VARCHAR, ' ' ORDER BY value), '') AS v FROM f GROUP BY 1, 2),
        m AS (SELECT paper_id, sum(n)::BIGINT AS n_facts, coalesce(string_agg(metric, ',' ORDER BY metric) FILTER (WHERE metric <> ''), '') AS metrics, coalesce(string_agg(metric || '=' || v, ';' ORDER BY metric) FILTER (WHERE metric <> ''), '') AS metric_values FROM v GROUP BY 1),
        q AS (SELECT l_orderkey AS paper_id, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS formula_classes, count(*) AS n_formulas FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1), b AS (SELECT l_orderkey AS paper_id, count(*) AS n_tables, count(*) FILTER (WHERE l_tax > 0.03) AS n_numeric_tables FROM lineitem WHERE l_quantity > 25 GROUP BY 1),
        r AS (SELECT l_orderkey AS paper_id, count(*) AS regions_count, count(*) FILTER (WHERE l_returnflag = 'A') AS formula_regions, count(*) FILTER (WHERE l_returnflag = 'N') AS table_regions, bool_or(l_partkey % 6 = 0 OR l_suppkey % 10 = 0) AS has_second_content FROM lineitem WHERE l_orderkey % 5 > 0 GROUP BY 1)
        SELECT o_orderkey AS paper_id, metrics, metric_values, n_facts, formula_classes, n_formulas, n_tables, n_numeric_tables, regions_count, formula_regions, table_regions, has_second_content FROM orders LEFT JOIN m ON m.paper_id = o_orderkey LEFT JOIN q ON q.paper_id = o_orderkey LEFT JOIN b ON b.paper_id = o_orderkey LEFT JOIN r ON r.paper_id = o_orderkey""",
)
def e_paper_summaries(t: Tables) -> DataFrame:
    """Papers with what their facts, formulas, tables and regions say together; what a paper has none of stays null."""
    c, rows = F.col, t.lineitem.withColumn("paper_id", F.col("l_orderkey"))
    facts = rows.filter("paper_id % 7 > 0").select("paper_id", F.element_at(F.array(*map(F.lit, _METRICS)), (c("l_linenumber") % 4 + 1).cast("int")).alias("metric"), F.when(c("l_partkey") % 5 > 0, c("l_discount")).alias("value"))
    formulas = rows.filter("l_linestatus = 'O'").select("paper_id", c("l_returnflag").alias("formula_class"))
    tables = rows.filter("l_quantity > 25").select("paper_id", (c("l_tax") > 0.03).alias("has_numeric_data"))
    kind = F.when(c("l_returnflag") == "A", "FORMULA_REGION").when(c("l_returnflag") == "N", "TABLE_REGION").otherwise("FIGURE_REGION")
    regions = rows.filter("paper_id % 5 > 0").select("paper_id", kind.alias("region_type"), F.when(c("l_partkey") % 6 == 0, "x").alias("latex"), F.when(c("l_suppkey") % 10 == 0, "y").otherwise("").alias("text"))
    told = O.summaries(t.orders.select(c("o_orderkey").alias("paper_id")), facts, formulas, tables, regions)
    values = F.array_join(F.transform(F.array_sort("metrics"), lambda m: F.concat(m, F.lit("="), F.array_join(F.transform(F.element_at("metric_values", m), lambda v: F.round(v * 100).cast("long").cast("string")), " "))), ";")
    return told.withColumns({"metric_values": values, "metrics": F.array_join("metrics", ","), "formula_classes": F.array_join("formula_classes", ",")})
