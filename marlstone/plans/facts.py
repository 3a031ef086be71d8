"""Queries on numeric facts from tables of cells, and on semantic rules over objects."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules as R
from ..operators import reasoning, tables
from .phrases import phrase, phrase_sql, quoted, table_sql
from .registry import Tables, query

HEADERS = ("NSE", "RMSE (m)", "Overall accuracy", "plain", "PBIAS", "R2", "F1-score", "Kappa", "CN", "hit rate", "width", "MAE [mm]", "mean bias error", "AUC")
_LINE_ORDER = "l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount"


def cell_tables(t: Tables) -> DataFrame:
    """Tables of cells from orders and their lines: two rows of headers, one, names of metrics in rows, or no metric at all."""
    kind, key = F.col("l_orderkey") % 4, F.col("l_orderkey")
    one, two = phrase(key, HEADERS, ((3, 1),)), phrase(key, HEADERS, ((5, 2),))
    lines = t.lineitem.withColumn("k", F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*_LINE_ORDER.split(", "))))
    tops = F.when(kind == 0, 2).when(kind == 2, 0).otherwise(1)
    number, percent = F.col("l_discount").cast("string"), F.concat(F.col("l_quantity").cast("string"), F.lit("%"))
    site = F.concat(F.lit("site "), F.col("k").cast("string"))
    body = F.when(kind == 2, F.array(F.lit(None).cast("string"), phrase(key + F.col("k"), HEADERS, ((3, 1),)), number, percent)).otherwise(F.array(site, number, percent, F.lit(" ")))
    body = lines.select(key.alias("table_id"), (F.col("k") - 1 + tops).cast("int").alias("row_no"), body.alias("cells"))
    heads = t.lineitem.select("l_orderkey").distinct()
    text = lambda *x: F.array(*[F.lit(v) if isinstance(v, str) or v is None else v for v in x]).cast("array<string>")
    top = F.when(kind == 0, F.array(text("", "Calibration", "Validation"), text("Station", one, two))).when(kind == 1, F.array(text("Site", one, two))).when(kind == 3, F.array(text("Site", "plain", "mirror")))
    return body.unionByName(heads.select(key.alias("table_id"), F.posexplode(top).alias("row_no", "cells")))


_RE2_RULES = [(p.replace("(?<![a-z])", "").replace("(?![a-z])", ""), m, u) for p, m, u in tables.HEADER_RULES]  # the word bounds say the same
_CELLS = f"""l AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER}) AS k FROM lineitem), o AS (SELECT DISTINCT l_orderkey AS t FROM lineitem),
    b AS (SELECT l_orderkey AS t, k - 1 + CASE l_orderkey % 4 WHEN 0 THEN 2 WHEN 2 THEN 0 ELSE 1 END AS r, CASE WHEN l_orderkey % 4 = 2 THEN [NULL, {phrase_sql('(l_orderkey + k)', HEADERS, ((3, 1),))}, l_discount::VARCHAR, l_quantity::VARCHAR || '%'] ELSE ['site ' || k, l_discount::VARCHAR, l_quantity::VARCHAR || '%', ' '] END AS c FROM l
      UNION ALL SELECT t, 0, CASE t % 4 WHEN 0 THEN ['', 'Calibration', 'Validation'] WHEN 1 THEN ['Site', {phrase_sql('t', HEADERS, ((3, 1),))}, {phrase_sql('t', HEADERS, ((5, 2),))}] ELSE ['Site', 'plain', 'mirror'] END FROM o WHERE t % 4 <> 2
      UNION ALL SELECT t, 1, ['Station', {phrase_sql('t', HEADERS, ((3, 1),))}, {phrase_sql('t', HEADERS, ((5, 2),))}] FROM o WHERE t % 4 = 0),
    x AS (SELECT t, r, unnest(c) AS cell, generate_subscripts(c, 1) - 1 AS p FROM b), v AS (SELECT *, try_cast(replace(regexp_replace(trim(cell), '%+$', ''), ',', '.') AS DOUBLE) AS v FROM x),
    s AS (SELECT t, r, count(cell) AS filled, count(v) AS numbers FROM v GROUP BY 1, 2), d AS (SELECT t, coalesce(min(r) FILTER (WHERE r < 4 AND filled > 0 AND numbers * 2 > filled), least(4, count(*))) AS depth, count(*) AS n FROM s GROUP BY 1),
    rules AS (SELECT * FROM {table_sql('pattern, metric, unit', _RE2_RULES)}), bounds AS (SELECT * FROM {table_sql('metric, low, high', [(m, *b) for m, b in tables.BOUNDS.items()])}),
    h AS (SELECT t, p, string_agg(trim(cell), ' ' ORDER BY r) AS header FROM v JOIN d USING (t) WHERE r < depth AND depth < n AND trim(coalesce(cell, '')) <> '' GROUP BY 1, 2),
    named AS (SELECT header AS text, arg_min(metric, ord) AS metric, arg_min(struct_pack(u := unit), ord).u AS unit FROM (SELECT DISTINCT header FROM h UNION SELECT DISTINCT trim(cell) FROM v) q(header) JOIN rules ON regexp_matches(regexp_replace(header, '\\([^)]{{1,25}}\\)\\s*$', ''), '(?i)' || pattern) GROUP BY 1),
    own AS (SELECT text, metric, coalesce(nullif(trim(regexp_extract(text, '\\(([^)]{{1,25}})\\)\\s*$', 1)), ''), unit) AS unit FROM named),
    cols AS (SELECT v.t, v.r, v.p, own.metric, unit, v.v, header, list(trim(lab.cell) ORDER BY lab.p) FILTER (WHERE trim(coalesce(lab.cell, '')) <> '' AND lab.v IS NULL) AS labels, 0.85 AS confidence FROM v JOIN d USING (t) JOIN h ON h.t = v.t AND h.p = v.p JOIN own ON own.text = header JOIN bounds ON bounds.metric = own.metric
      LEFT JOIN v lab ON lab.t = v.t AND lab.r = v.r AND lab.p < v.p WHERE v.r >= depth AND v.v BETWEEN low AND high GROUP BY v.t, v.r, v.p, own.metric, unit, v.v, header),
    lead AS (SELECT t, r, min(p) AS named_at FROM v JOIN own ON own.text = trim(cell) WHERE t NOT IN (SELECT t FROM cols) GROUP BY 1, 2),
    byrow AS (SELECT v.t, v.r, v.p, own.metric, unit, v.v, own.text AS header, NULL AS labels, 0.80 AS confidence FROM lead JOIN v ON v.t = lead.t AND v.r = lead.r AND v.p > named_at JOIN v n ON n.t = lead.t AND n.r = lead.r AND n.p = named_at JOIN own ON own.text = trim(n.cell) JOIN bounds ON bounds.metric = own.metric WHERE v.v BETWEEN low AND high),
    facts AS (SELECT * FROM cols UNION ALL SELECT * FROM byrow)"""


@query(
    "E4 E5 E6",
    f"""WITH {_CELLS} SELECT t AS table_id, r::INT AS row_no, p::INT AS place, metric, unit, v AS value, header, coalesce(array_to_string(labels, '|'), '') AS row_labels, confidence::DOUBLE AS confidence,
        substr(sha1(t || '|' || metric || '|' || printf('%.8f', v) || '|' || (row_number() OVER (PARTITION BY t ORDER BY r, p) - 1)), 1, 16) AS fact_id FROM facts""",
)
def e_table_facts(t: Tables) -> DataFrame:
    facts = tables.numeric_facts(cell_tables(t))
    return facts.select("table_id", "row_no", "place", "metric", "unit", "value", "header", F.array_join("row_labels", "|").alias("row_labels"), "confidence", "fact_id")


@query("E36", f"WITH {_CELLS} SELECT t AS table_id, metric, first(v ORDER BY confidence DESC, r, p) AS best, max(confidence)::DOUBLE AS confidence, count(*) AS n FROM facts GROUP BY 1, 2")
def e_best_values(t: Tables) -> DataFrame:
    return tables.best_values(tables.numeric_facts(cell_tables(t)))


# --- semantic rules over figures, tables and equations -----------------------------------------------------------------

CAPTIONS = ("hydrograph", "simulated", "observed", "uncertainty", "Sentinel", "scatter", "R2", "NSE of LSTM", "SWAT", "parameters", "flood extent", "NDVI", "plain", "SCS-CN", "Manning n", "Saint-Venant", "pearson", "confidence interval", "VIC")
SECTIONS = ("Results", "Methods", "Study area", "Conclusions", "Introduction", "Model setup")
AROUND = ("the channel", "HEC-RAS runs", "nothing else", "a floodplain")
KINDS = ("figure", "table", "equation")
_PICKS = ((7, 1), (11, 3), (13, 5))


def objects(t: Tables) -> DataFrame:
    """object_id, kind, caption, section and the section's text, from parts."""
    key = F.col("p_partkey")
    return t.part.select(key.alias("object_id"), phrase(key, KINDS, ((1, 0),)).alias("kind"), phrase(key, CAPTIONS, _PICKS).alias("caption"), phrase(key, SECTIONS, ((5, 2),)).alias("section"), phrase(key, AROUND, ((3, 1),)).alias("around"))


def _re(column: str, pattern: str) -> str:
    return f"regexp_matches({column}, {quoted('(?i)' + pattern)})"


_TYPE_SQL = "CASE kind " + " ".join(f"WHEN '{k}' THEN CASE {' '.join(f'WHEN {_re("caption", p)} THEN {quoted(n)}' for p, n, _ in rules)} ELSE {quoted(d[0])} END" for k, rules, d in (("figure", R.FIGURE_RULES, R.FIGURE_DEFAULT), ("table", R.TABLE_RULES, R.TABLE_DEFAULT), ("equation", R.EQUATION_RULES, R.EQUATION_DEFAULT))) + " END"
_SCORE_SQL = "CASE kind " + " ".join(f"WHEN '{k}' THEN CASE {' '.join(f'WHEN {_re("caption", p)} THEN {s}' for p, _, s in rules)} ELSE {d[1]} END" for k, rules, d in (("figure", R.FIGURE_RULES, R.FIGURE_DEFAULT), ("table", R.TABLE_RULES, R.TABLE_DEFAULT), ("equation", R.EQUATION_RULES, R.EQUATION_DEFAULT))) + " END"
_MODELS_SQL = f"list_distinct(list_transform(regexp_extract_all(caption, {quoted('(?i)' + R.MODEL_SIGNALS)}), lambda x: upper(x)))"
# each rule once more, as SQL
_RULES_SQL = [
    ("R01_hydrograph_in_results", f"kind = 'figure' AND semantic_type = 'hydrograph' AND {_re('section', r'\bresult')}"),
    ("R02_simulated_in_caption", f"kind = 'figure' AND {_re('caption', r'\bsimulated\b')}"),
    ("R03_observed_vs_simulated", f"kind IN ('figure', 'table') AND {_re('caption', r'\bobserved\b')} AND {_re('caption', r'\bsimulated\b')}"),
    ("R04_uncertainty_figure", f"kind = 'figure' AND {_re('caption', r'\b(uncertainty|confidence.interval|prediction.band|ensemble.spread)\b')}"),
    ("R05_satellite_in_study_area", f"kind = 'figure' AND semantic_type = 'satellite_image' AND {_re('section', r'\b(study.area|case.study|site|watershed)\b')}"),
    ("R06_scatter_with_r2", f"kind = 'figure' AND semantic_type = 'scatter_plot' AND {_re('caption', r'\b(r[²2]|r\s*=|correlation|pearson)\b')}"),
    ("R07_metrics_table_multi_model", f"kind = 'table' AND semantic_type IN ('metrics_table', 'comparison_table') AND len({_MODELS_SQL}) >= 2"),
    ("R08_metrics_table_in_results", f"kind = 'table' AND semantic_type = 'metrics_table' AND {_re('section', r'\bresult')}"),
    ("R09_param_table_in_methods", f"kind = 'table' AND semantic_type = 'parameter_table' AND {_re('section', r'\b(method|calibrat|model.setup)\b')}"),
    ("R10_saint_venant_hec_ras", f"kind = 'equation' AND {_re('caption', r'\bsaint.venant\b')} AND {_re('around', r'\bhec.?ras\b')}"),
    ("R11_scs_cn_rainfall_runoff", f"kind = 'equation' AND {_re('caption', r'\b(scs.?cn|curve.number)\b')}"),
    ("R12_manning_hydraulic", f"kind = 'equation' AND {_re('caption', r'\bmanning')} AND {_re('around', r'\b(channel|river|flood.plain|floodplain)\b')}"),
    ("R13_conclusion_figure", f"kind = 'figure' AND {_re('section', r'\b(conclus|summary|recommendation)\b')}"),
    ("R14_flood_figure_task", f"kind = 'figure' AND semantic_type IN ('flood_extent_map', 'hydrograph')"),
    ("R15_rs_vegetation_figure", f"kind = 'figure' AND {_re('caption', R.SATELLITE_SIGNALS)} AND {_re('caption', r'\b(ndvi|ndwi|vegetation|drought|land.use|lulc|land.cover)\b')}"),
]
_DELTAS = {r.name: r.gain for r in reasoning.RULES}


@query(
    "E25",
    f"""WITH o AS (SELECT p_partkey AS object_id, {phrase_sql('p_partkey', KINDS, ((1, 0),))} AS kind, {phrase_sql('p_partkey', CAPTIONS, _PICKS)} AS caption, {phrase_sql('p_partkey', SECTIONS, ((5, 2),))} AS section, {phrase_sql('p_partkey', AROUND, ((3, 1),))} AS around FROM part),
        c AS (SELECT *, {_TYPE_SQL} AS semantic_type, {_SCORE_SQL} AS score FROM o), f AS ({' UNION ALL '.join(f"SELECT object_id, {quoted(n)} AS rule, {_DELTAS[n]} AS gain FROM c WHERE {w}" for n, w in _RULES_SQL)}),
        s AS (SELECT object_id, string_agg(rule, ',' ORDER BY rule) AS fired, sum(gain) AS gain FROM f GROUP BY 1)
        SELECT object_id, semantic_type, coalesce(fired, '') AS fired, round(least(1.0, score + coalesce(gain, 0)), 4)::DOUBLE AS confidence FROM c LEFT JOIN s USING (object_id)""",
)
def e_semantic_rules(t: Tables) -> DataFrame:
    """All rules of the list that hold, each once, with what they add to the confidence of an object's type."""
    return reasoning.annotated(objects(t)).select("object_id", "semantic_type", F.array_join("fired", ",").alias("fired"), F.round("confidence", 4).alias("confidence"))


_ROLE_ROWS = [(r.name, x) for r in reasoning.RULES for x in (*r.roles, *r.tasks)]


@query(
    "E37 E39",
    f"""WITH o AS (SELECT p_partkey AS object_id, {phrase_sql('p_partkey', KINDS, ((1, 0),))} AS kind, {phrase_sql('p_partkey', CAPTIONS, _PICKS)} AS caption, {phrase_sql('p_partkey', SECTIONS, ((5, 2),))} AS section, {phrase_sql('p_partkey', AROUND, ((3, 1),))} AS around FROM part),
        c AS (SELECT *, {_TYPE_SQL} AS semantic_type FROM o), f AS ({' UNION ALL '.join(f"SELECT object_id, {quoted(n)} AS rule FROM c WHERE {w}" for n, w in _RULES_SQL)}), r AS (SELECT DISTINCT object_id, mark FROM f JOIN {table_sql('name, mark', _ROLE_ROWS)} ON name = rule)
        SELECT mark, count(*) AS n, min(object_id) AS first_object FROM r GROUP BY 1""",
)
def e_roles_and_tasks(t: Tables) -> DataFrame:
    """How many objects get each role or task from the rules."""
    marks = reasoning.annotated(objects(t)).select("object_id", F.explode(F.array_distinct(F.concat("roles", "tasks"))).alias("mark"))
    return marks.groupBy("mark").agg(F.count("*").alias("n"), F.min("object_id").alias("first_object"))


@query(
    "E26",
    """WITH r AS (SELECT o_orderkey, (o_totalprice > 200000)::INT * 0.08 + (o_orderstatus = 'F')::INT * 0.06 + (o_orderpriority LIKE '1%')::INT * 0.04 AS gain, (o_totalprice > 200000 AND o_orderstatus = 'P')::INT * 0.10 AS loss FROM orders)
       SELECT o_orderkey, round(greatest(0, least(1, 0.5 + gain - loss)), 4)::DOUBLE AS confidence FROM r""",
)
def e_declarative_rules(t: Tables) -> DataFrame:
    """Independent rules add to the confidence, then constraints take from it, once each."""
    rules = [(F.col("o_totalprice") > 200000, 0.08), (F.col("o_orderstatus") == "F", 0.06), (F.col("o_orderpriority").startswith("1"), 0.04)]
    constraints = [((F.col("o_totalprice") > 200000) & (F.col("o_orderstatus") == "P"), 0.10)]
    fired = lambda group: sum((F.when(c, d).otherwise(F.lit(0.0)) for c, d in group), F.lit(0.0))
    return t.orders.select("o_orderkey", F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 0.5 + fired(rules) - fired(constraints))), 4).alias("confidence"))
