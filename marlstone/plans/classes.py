"""Queries on ordered rules: types of objects, places, sensors, studies and failures. The SQL looks rules up in tables of values and takes the first that holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from .phrases import phrase, phrase_sql, quoted, table_sql
from .registry import Tables, query

WORDS = (
    "NSE", "plain", "accuracy of", "Comparing", "thresholds", "Gauges at", "r2", "mirror", "hydrograph", "observed vs", "flood map", "calibrated", "Sentinel", "catchment", "workflow", "bar chart", "Manning", "linear fit",
    "terror", "opposite", "discharge", "where x is the y", "CN", "unit hydrograph", "routing", "land use", "peak  flow", "storm", "validation", "value range", "root mean square", "mass balance", "Saint-Venant", "rational method", "coefficient of determination",
)
PICKS = ((7, 1), (11, 3), (13, 5))
TITLES = ("Methods and data", "Results", "Dataset", "Study area", "Introduction", "Summary", "Other things", "model setup", "Findings", "The results")
SPOTS = ("Dniester", "Danube", "Vistula", "Kyiv", "worldwide", "Texas", "nowhere", "eastern europe", "Vietnam", "", "Prut", "England")
SENSORS = ("Sentinel-1B", "Landsat 8", "gaofen", "S2A", "ICEYE", "modis", "", "planet", "radarsat", "sentinel 2")
STUDIES = ("systematic review", "survey of", "flood dataset", "open dataset", "HEC-RAS", "streamflow", "early warning system", "U-Net", "deep learning", "random forest", "SVM", "nothing", "rain", "fields", "words", "maps")
TASKS = ("HEC-HMS", "2D flood model", "SWAT", "runoff", "watershed", "flood", "mapping", "NDVI", "rain", "fields", "words", "cities", "roads")
TIMES = ("near-real-time", "rapid mapping", "latency: 6 hours", "NRT", "operational flood monitoring", "delivered within 2 days", "nothing", "maps", "trees")
PERIODS = ("cal", "Validation", "NSE", "test", "calibrated", "fitting", "run", "value")
REFERENCES = ("Landsat", "LISFLOOD", "SWAT", "U-Net CNN", "terrain", "kappa", "GIS", "poems", "stories", "songs", "letters", "history")
BODIES = ("[NO_BLOCKS] x", "x [TIMEOUT] y", "[GENERAL]", "nothing", "[BAD_INPUT_DATA]", "[TOO_MANY_TOKENS]", "[PARSING_ERROR]")
KINDS = ("SUCCESS", "PARTIAL", "INVALID_XML", "EMPTY_TEI", "NOUGAT_OOM", "HTTP_503", "PDF_ENCRYPTED", "PDF_CORRUPTED", "TIMEOUT", "UNKNOWN")

# Tasks by their signals, in order; of the third and fourth either a word or a pair of words.
MODELLING = ("hec-hms", "hec hms", "scs-cn", "scs cn", "curve number", "unit hydrograph", "muskingum", "rainfall-runoff modelling", "rainfall runoff modelling", "rainfall-runoff modeling", "rainfall runoff modeling")
HYDRAULIC = ("hec-ras", "2d flood model", "hydraulic simulation", "hydraulic flood", "1d/2d")
FLOW = ("watershed", "streamflow", "hydrograph")
EXTENT = ("mapping", "extent", "inundation", "water extent")
INDICES = ("ndvi", "ndwi", "ndii", "rdi")
# Signals of timeliness.
SOON = r"near[\s-]?real[\s-]?time|near\s+real\s+time|\bNRT\b|real[\s-]time\s+flood"
MAYBE_SOON = r"rapid\s+(?:flood\s+)?mapping|operational\s+flood\s+monitoring|automated\s+(?:flood\s+)?mapping|near\s+real\s+time\s+(?:flood|mapping)"
LATENCY = r"(?:latency|delivered\s+within|available\s+within|within\s+less\s+than|processing\s+time\s+of)\s*[:\-]?\s*(\d+(?:\.\d+)?)\s*(hours?|days?|h\b|d\b)"


def first_rule_sql(key: str, source: str, text: str, rules, default: tuple, columns: str = "label, score") -> str:
    """(key, columns) of the first rule whose pattern each row's text holds."""
    names = columns.split(", ")
    picked = ", ".join(f"coalesce(arg_min({n}, ord), {quoted(d) if isinstance(d, str) else 'NULL' if d is None else d}) AS {n}" for n, d in zip(names, default, strict=True))
    return f"SELECT {key}, {picked} FROM {source} LEFT JOIN {table_sql('pattern, ' + columns, rules)} ON regexp_matches({text}, '(?i)' || pattern) GROUP BY {key}"


def words_sql(words) -> str:
    return "[" + ", ".join(map(quoted, words)) + "]"


def holds_sql(text: str, words) -> str:
    return f"len(list_filter({words_sql(words)}, lambda x_: contains(lower({text}), x_)))"


_OBJECTS = f"(SELECT p_partkey, {phrase_sql('p_partkey', WORDS, PICKS)} AS caption, {phrase_sql('p_partkey', TITLES, ((3, 2),))} AS title FROM part)"


@query(
    "C11",
    f"""WITH o AS {_OBJECTS}, t AS ({first_rule_sql('p_partkey', 'o', 'caption', R.TABLE_RULES, R.TABLE_DEFAULT)}), f AS ({first_rule_sql('p_partkey', 'o', 'caption', R.FIGURE_RULES, R.FIGURE_DEFAULT)}),
        e AS ({first_rule_sql('p_partkey', 'o', 'caption', R.EQUATION_RULES, R.EQUATION_DEFAULT)}), s AS ({first_rule_sql('p_partkey', 'o', 'title', R.SECTION_RULES, R.SECTION_DEFAULT)})
        SELECT p_partkey, t.label AS as_table, t.score::DOUBLE AS table_score, f.label AS as_figure, f.score::DOUBLE AS figure_score, e.label AS as_equation, e.score::DOUBLE AS equation_score, s.label AS section, s.score::DOUBLE AS section_score
        FROM t JOIN f USING (p_partkey) JOIN e USING (p_partkey) JOIN s USING (p_partkey)""",
)
def c_semantic_types(t: Tables) -> DataFrame:
    caption, title = phrase(F.col("p_partkey"), WORDS, PICKS), phrase(F.col("p_partkey"), TITLES, ((3, 2),))
    rows = t.part.select("p_partkey", caption.alias("c"), title.alias("t"))
    kinds = {"table": ("c", R.TABLE_RULES, R.TABLE_DEFAULT), "figure": ("c", R.FIGURE_RULES, R.FIGURE_DEFAULT), "equation": ("c", R.EQUATION_RULES, R.EQUATION_DEFAULT), "section": ("t", R.SECTION_RULES, R.SECTION_DEFAULT)}
    rows = rows.select("p_partkey", *[R.first_match(F.col(of), rules, default).alias(k) for k, (of, rules, default) in kinds.items()])
    return rows.select("p_partkey", *[F.col(f"{k}.label").alias("section" if k == "section" else f"as_{k}") for k in kinds], *[F.col(f"{k}.score").alias(f"{k}_score") for k in kinds])


@query("C10", f"WITH o AS {_OBJECTS} {first_rule_sql('p_partkey', 'o', 'caption', R.FORMULA_RULES, (None,), 'label')}")
def c_formula_class(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", R.first_label(phrase(F.col("p_partkey"), WORDS, PICKS), R.FORMULA_RULES).alias("label"))


_SYMBOLS = tuple(R.EQUATION_SYMBOLS)[:9] + ("z", "NS")


@query(
    "C12",
    f"""WITH o AS (SELECT p_partkey, {phrase_sql('p_partkey', WORDS, PICKS)} AS caption, {phrase_sql('p_partkey', _SYMBOLS, ((5, 1),))} AS lhs FROM part), f AS ({first_rule_sql('p_partkey', 'o', 'caption', R.CAPTION_FIGURES, (None,), 'label')}),
        t AS ({first_rule_sql('p_partkey', 'o', 'caption', R.CAPTION_TABLES, ('other',), 'label')}), e AS ({first_rule_sql('p_partkey', 'o', 'caption', R.EQUATION_CONTEXTS, ('other',), 'label')})
        SELECT o.p_partkey, coalesce(f.label, CASE WHEN o.p_partkey % 2 = 0 THEN 'chart' ELSE 'other' END) AS figure, t.label AS tab, coalesce(s.kind, e.label) AS equation
        FROM o JOIN f USING (p_partkey) JOIN t USING (p_partkey) JOIN e USING (p_partkey) LEFT JOIN {table_sql('symbol, kind', list(R.EQUATION_SYMBOLS.items()))} ON v.symbol = o.lhs""".replace("v(ord, symbol, kind)", "s(ord, symbol, kind)").replace("ON v.symbol", "ON s.symbol"),
)
def c_captioned(t: Tables) -> DataFrame:
    caption = phrase(F.col("p_partkey"), WORDS, PICKS)
    region = F.when(F.col("p_partkey") % 2 == 0, "chart").otherwise("other")
    symbol = phrase(F.col("p_partkey"), _SYMBOLS, ((5, 1),))
    return t.part.select("p_partkey", R.first_label(caption, R.CAPTION_FIGURES, region).alias("figure"), R.first_label(caption, R.CAPTION_TABLES, "other").alias("tab"), R.equation_type(symbol, caption).alias("equation"))


_HELD = "SELECT label FROM {} WHERE contains(lower({}), word) ORDER BY ord LIMIT 1"


@query(
    "C3 C8 C18 C19",
    f"""WITH s AS (SELECT s_suppkey, {phrase_sql('s_suppkey', SENSORS, ((3, 1), (7, 2)))} AS sensors, {phrase_sql('s_suppkey', SENSORS, ((3, 1),))} AS one, {phrase_sql('s_suppkey', SPOTS, ((5, 1), (7, 2)))} AS place FROM supplier),
        n AS ({first_rule_sql('s_suppkey', 's', 'one', R.SATELLITES, (None,), 'label')}), c AS (SELECT s_suppkey, arg_min(label, ord) AS country FROM s LEFT JOIN {table_sql('word, label', R.COUNTRY_RULES)} ON contains(lower(place), word) GROUP BY 1),
        k AS (SELECT s_suppkey, {holds_sql('sensors', R.SAR_WORDS)} > 0 AS sar, {holds_sql('sensors', R.OPTICAL_WORDS)} > 0 AS optical FROM s)
        SELECT s_suppkey, CASE WHEN sar AND optical THEN 'Multi-sensor' WHEN sar THEN 'SAR' WHEN optical THEN 'Optical' ELSE nullif(trim(sensors), '') END AS sensor,
               coalesce(n.label, upper(substr(one, 1, 1)) || lower(substr(one, 2))) AS satellite, country FROM s JOIN n USING (s_suppkey) JOIN c USING (s_suppkey) JOIN k USING (s_suppkey)""",
)
def c_sensor_country(t: Tables) -> DataFrame:
    key = F.col("s_suppkey")
    return t.supplier.select(
        "s_suppkey", R.sensor_kind(phrase(key, SENSORS, ((3, 1), (7, 2)))).alias("sensor"), R.satellite(phrase(key, SENSORS, ((3, 1),))).alias("satellite"),
        R.first_word(phrase(key, SPOTS, ((5, 1), (7, 2))), R.COUNTRY_RULES).alias("country"),
    )


@query(
    "C4",
    f"""WITH s AS (SELECT c_custkey, {phrase_sql('c_custkey', SPOTS, ((5, 1), (7, 3)))} AS place, c_custkey % 17 = 0 AS flagged FROM customer),
        l AS (SELECT c_custkey, arg_min(level, ord) AS level FROM s LEFT JOIN {table_sql('level, words', [(n, None) for n, _ in R.GEO_LEVELS])} ON len(list_filter(CASE level {' '.join(f'WHEN {quoted(n)} THEN {words_sql(w)}' for n, w in R.GEO_LEVELS)} END, lambda w: contains(lower(place), w))) > 0 GROUP BY 1)
        SELECT c_custkey, CASE WHEN flagged THEN 'Ukraine-specific' WHEN level IS NOT NULL THEN level WHEN trim(place) = '' THEN 'Unspecified' ELSE 'Other region' END AS level FROM s JOIN l USING (c_custkey)""",
)
def c_geo_level(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", R.geo_level(phrase(F.col("c_custkey"), SPOTS, ((5, 1), (7, 3))), F.col("c_custkey") % 17 == 0).alias("level"))


_STUDY_SQL = " UNION ALL ".join(f"SELECT o_orderkey, {k} AS ord, {quoted(n)} AS study FROM s WHERE {holds_sql('words', w)} >= {least}" for k, (n, least, w) in enumerate(R.STUDY_TYPES))


@query(
    "C5",
    f"""WITH s AS (SELECT o_orderkey, {phrase_sql('o_orderkey', STUDIES, ((3, 1), (5, 2), (7, 3)))} AS words FROM orders), h AS ({_STUDY_SQL}), b AS (SELECT o_orderkey, arg_min(study, ord) AS study FROM h GROUP BY 1)
        SELECT o_orderkey, coalesce(study, {quoted(R.STUDY_DEFAULT)}) AS study FROM s LEFT JOIN b USING (o_orderkey)""",
)
def c_study_type(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", R.study_type(phrase(F.col("o_orderkey"), STUDIES, ((3, 1), (5, 2), (7, 3)))).alias("study"))


@query(
    "C7",
    f"""WITH s AS (SELECT o_orderkey, lower({phrase_sql('o_orderkey', TASKS, ((3, 1), (5, 2), (7, 3)))}) AS w FROM orders)
        SELECT o_orderkey, CASE WHEN {holds_sql('w', MODELLING)} > 0 THEN 'hydrological_modeling' WHEN {holds_sql('w', HYDRAULIC)} > 0 THEN 'flood_modeling_hydraulic' WHEN contains(w, 'swat') OR (contains(w, 'runoff') AND {holds_sql('w', FLOW)} > 0) THEN 'hydrological_modeling'
               WHEN contains(w, 'flood') AND {holds_sql('w', EXTENT)} > 0 THEN 'flood_mapping_satellite' WHEN {holds_sql('w', INDICES)} > 0 THEN 'spectral_index_analysis' ELSE 'unknown' END AS task FROM s""",
)
def c_task(t: Tables) -> DataFrame:
    text = phrase(F.col("o_orderkey"), TASKS, ((3, 1), (5, 2), (7, 3)))
    low = F.lower(text)
    task = (
        F.when(R.has_any(text, MODELLING), "hydrological_modeling").when(R.has_any(text, HYDRAULIC), "flood_modeling_hydraulic")
        .when(low.contains("swat") | (low.contains("runoff") & R.has_any(text, FLOW)), "hydrological_modeling")
        .when(low.contains("flood") & R.has_any(text, EXTENT), "flood_mapping_satellite").when(R.has_any(text, INDICES), "spectral_index_analysis").otherwise("unknown")
    )
    return t.orders.select("o_orderkey", task.alias("task"))


@query(
    "C9",
    f"""WITH s AS (SELECT o_orderkey, {phrase_sql('o_orderkey', TIMES, ((3, 1), (5, 2)))} AS w FROM orders), l AS (SELECT o_orderkey, w, regexp_extract(w, {quoted('(?i)' + LATENCY)}, ['n', 'unit']) AS x FROM s)
        SELECT o_orderkey, CASE WHEN x.n = '' THEN '' ELSE x.n || ' ' || x.unit END AS latency, CASE WHEN regexp_matches(w, {quoted('(?i)' + SOON)}) OR (regexp_matches(w, {quoted('(?i)' + MAYBE_SOON)}) AND x.n <> '') THEN 'true' WHEN regexp_matches(w, {quoted('(?i)' + MAYBE_SOON)}) THEN 'unclear' ELSE '' END AS soon FROM l""",
)
def c_timeliness(t: Tables) -> DataFrame:
    text = phrase(F.col("o_orderkey"), TIMES, ((3, 1), (5, 2)))
    latency = F.concat_ws(" ", *[F.nullif(F.regexp_extract(text, f"(?i){LATENCY}", k), F.lit("")) for k in (1, 2)])
    soon = F.when(R.matches(text, SOON) | (R.matches(text, MAYBE_SOON) & (latency != "")), "true").when(R.matches(text, MAYBE_SOON), "unclear").otherwise("")
    return t.orders.select("o_orderkey", latency.alias("latency"), soon.alias("soon"))


@query(
    "C14",
    f"""WITH s AS (SELECT l_orderkey, l_linenumber, string_split(lower({phrase_sql('(l_orderkey + l_linenumber)', PERIODS, ((3, 1), (5, 2)))}), ' ') AS w FROM lineitem)
        SELECT l_orderkey, l_linenumber, CASE WHEN list_has_any(w, {words_sql(R.CALIBRATION_TERMS)}) THEN 'CALIBRATION' WHEN list_has_any(w, {words_sql(R.VALIDATION_TERMS)}) THEN 'VALIDATION' END AS period FROM s""",
)
def c_period(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber", R.period_type(phrase(F.col("l_orderkey") + F.col("l_linenumber"), PERIODS, ((3, 1), (5, 2)))).alias("period"))


_CATEGORY_SQL = " UNION ALL ".join(f"SELECT p_partkey, {k} AS ord, {quoted(n)} AS category FROM s WHERE {holds_sql('title', w)} > 0" for k, (n, w) in enumerate(R.REFERENCE_CATEGORIES))


@query(
    "C15",
    f"""WITH s AS (SELECT p_partkey, {phrase_sql('p_partkey', REFERENCES, ((3, 1), (5, 2)))} AS title FROM part), h AS ({_CATEGORY_SQL}), b AS (SELECT p_partkey, arg_min(category, ord) AS category FROM h GROUP BY 1)
        SELECT p_partkey, coalesce(category, 'General EO') AS category FROM s LEFT JOIN b USING (p_partkey)""",
)
def c_reference_category(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", R.first_group(phrase(F.col("p_partkey"), REFERENCES, ((3, 1), (5, 2))), R.REFERENCE_CATEGORIES, "General EO").alias("category"))


@query(
    "C16",
    """WITH s AS (SELECT o_orderkey, o_orderkey % 3 <> 0 AS doi_valid, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice > 150000 END AS title_ok FROM orders)
       SELECT o_orderkey, CASE WHEN NOT doi_valid THEN 'doi_not_found' WHEN title_ok IS NULL THEN 'doi_only' WHEN title_ok THEN 'verified' ELSE 'doi_mismatch' END AS status FROM s""",
)
def c_citation_status(t: Tables) -> DataFrame:
    valid, ok = F.col("o_orderkey") % 3 != 0, F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice") > 150000)
    return t.orders.select("o_orderkey", F.when(~valid, "doi_not_found").when(ok == F.lit(False), "doi_mismatch").when(ok, "verified").otherwise("doi_only").alias("status"))


@query(
    "C17 R3",
    f"""WITH s AS (SELECT event_id, {phrase_sql('event_id', BODIES, ((3, 1),))} AS body, {phrase_sql('event_id', KINDS, ((7, 3),))} AS kind FROM events), c AS (SELECT event_id, body, kind, regexp_extract(body, '\\[([A-Z_]+)\\]', 1) AS code FROM s),
        k AS (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN kind WHEN code IN ('', 'GENERAL') THEN 'HTTP_500' WHEN code = 'TIMEOUT' THEN 'GROBID_TIMEOUT' ELSE code END AS failure FROM c)
        SELECT event_id, failure, CASE WHEN failure IN ('SUCCESS', 'PARTIAL') THEN 'SUCCESS' WHEN failure IN ({', '.join(map(quoted, R.SKIPPED))}) THEN 'SKIPPED' WHEN failure = 'INVALID_XML' THEN 'INVALID_XML' WHEN failure = 'EMPTY_TEI' THEN 'EMPTY_OUTPUT'
               WHEN failure = 'NOUGAT_OOM' OR failure IN ({', '.join(map(quoted, R.RETRIABLE))}) THEN 'RETRY' ELSE 'FAIL' END AS status, CASE WHEN status = 'RETRY' THEN 60 * 5 ** least(event_id % 4, 3) END::BIGINT AS wait_s FROM k""",
)
def c_failure_action(t: Tables) -> DataFrame:
    key = F.col("event_id")
    kind = F.when(key % 2 == 0, phrase(key, KINDS, ((7, 3),))).otherwise(R.failure_kind(phrase(key, BODIES, ((3, 1),))))
    rows = t.events.select("event_id", kind.alias("failure")).withColumn("status", R.failure_status(F.col("failure")))
    wait = F.when(F.col("status") == "RETRY", F.lit(60) * F.pow(F.lit(5), F.least(key % 4, F.lit(3))))
    return rows.withColumn("wait_s", wait.cast("long"))
