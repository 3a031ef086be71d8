"""Queries on cleaning, validating and merging extracted records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..operators import refine as X
from .phrases import phrase, phrase_sql, quoted
from .registry import Tables, query

# Patterns of overall accuracy, ranges first.
_NUMBER, _SEP = r"(-?[\d]+\.?[\d]*)", r"\s*(?:[=:>]|of|was|is|at|:|=)?\s*"
ACCURACY = (
    (rf"overall\s+accuracy{_SEP}{_NUMBER}\s*[-–]\s*{_NUMBER}%?", 2), (rf"\bOA{_SEP}{_NUMBER}\s*[-–]\s*{_NUMBER}%?", 2), (rf"overall\s+accuracy{_SEP}{_NUMBER}%?", 1), (rf"\bOA\b{_SEP}{_NUMBER}%?", 1),
    (rf"accuracy\s+of\s+{_NUMBER}%?", 1), (rf"accuracy\s+rate{_SEP}{_NUMBER}%?", 1), (rf"accuracy{_SEP}{_NUMBER}%?", 1),
)
SAID = ("OA = 0.8-0.9", "overall accuracy was 95%", "accuracy of 230", "OA 91", "accuracy rate: 0.5", "OA of 0.9 - 0.2", "nothing", "accuracy -3", "kappa 0.7")
_SAID_PICKS = ((3, 1), (5, 2))


def _scan_sql() -> str:
    out = []
    for p, groups in ACCURACY:
        one = lambda g, p=p: f"list_transform(regexp_extract_all(w, {quoted('(?i)' + p)}, {g}), lambda x: CASE WHEN x::DOUBLE > 1 THEN x::DOUBLE / 100 ELSE x::DOUBLE END)"
        out.append(f"list_filter({one(1)}, lambda v: v BETWEEN 0 AND 1)" if groups == 1 else f"list_transform(list_filter(list_zip({one(1)}, {one(2)}), lambda r: r[1] >= 0 AND r[1] <= r[2] AND r[2] <= 1), lambda r: (r[1] + r[2]) / 2)")
    return f"round(flatten([{', '.join(out)}])[1], 4)"


@query("E7", f"WITH s AS (SELECT o_orderkey, {phrase_sql('o_orderkey', SAID, _SAID_PICKS)} AS w FROM orders) SELECT o_orderkey, {_scan_sql()} AS value FROM s")
def e_metric_patterns(t: Tables) -> DataFrame:
    """Accuracies told in texts, by ordered patterns."""
    return t.orders.select("o_orderkey", X.scanned(phrase(F.col("o_orderkey"), SAID, _SAID_PICKS), ACCURACY, 0.0, 1.0).alias("value"))


PLACES = ("results", "abstract", "", "table", "methods")
LANDS = ("Study area.", "France", " the study region", "", "Peru")


@query(
    "E31",
    f"""WITH s AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN 0.5 END AS m, {phrase_sql('o_orderkey', PLACES, ((1, 0),))} AS ms, CASE WHEN o_orderkey % 4 = 0 THEN 'x' ELSE '' END AS h, {phrase_sql('o_orderkey', PLACES, ((3, 1),))} AS hs, {phrase_sql('o_orderkey', LANDS, ((7, 2),))} AS c FROM orders)
        SELECT o_orderkey, CASE WHEN m IS NOT NULL AND ms NOT IN ('', 'results', 'table', 'sodb_parquet', 'paper_entities') THEN 'metric_section' WHEN h <> '' AND hs NOT IN ('', 'methods', 'abstract+methods') THEN 'methods_section'
               WHEN regexp_replace(trim(lower(c)), '\\.+$', '') IN ('study area', 'the study area', 'study region') THEN 'generic_country' END AS reason FROM s""",
)
def e_validity(t: Tables) -> DataFrame:
    """Records from wrong sections or of no country."""
    k = F.col("o_orderkey")
    metric = F.when(F.col("o_orderstatus") != "P", 0.5)
    return t.orders.select("o_orderkey", X.rejection(metric, phrase(k, PLACES, ((1, 0),)), F.when(k % 4 == 0, "x").otherwise(""), phrase(k, PLACES, ((3, 1),)), phrase(k, LANDS, ((7, 2),))).alias("reason"))


METHODS = ("rf, SVM,rf", "Random forest,  cnn", "", "unet , U-NET", "otsu")
NAMES = {"rf": "Random Forest", "random forest": "Random Forest", "cnn": "CNN", "unet": "U-Net", "u-net": "U-Net", "svm": "SVM"}
SENSORS = ("Sentinel-1", "landsat and ERS", "", "drone")
TEXTS = ("floods of the Prut", "in Vietnam", "of nowhere")


@query(
    "E29 E30",
    f"""WITH s AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN 'not a doi' ELSE '10.1234/x' || o_orderkey END AS doi, {phrase_sql('o_orderkey', METHODS, ((1, 0),))} AS m, {phrase_sql('o_orderkey', SENSORS, ((3, 1),))} AS sensor, CASE WHEN o_orderkey % 2 = 0 THEN 'France' ELSE ' ' END AS c, {phrase_sql('o_orderkey', TEXTS, ((5, 2),))} AS text, o_totalprice AS price FROM orders),
        m AS (SELECT id, unnest(string_split(m, ',')) AS p, generate_subscripts(string_split(m, ','), 1) AS i FROM s), n AS (SELECT id, i, coalesce(canon, trim(p)) AS p FROM m LEFT JOIN (VALUES {', '.join(f'({quoted(a)}, {quoted(b)})' for a, b in NAMES.items())}) v(alias, canon) ON alias = lower(trim(p)) WHERE trim(p) <> ''),
        d AS (SELECT id, p, min(i) AS i FROM n GROUP BY 1, 2), l AS (SELECT id, string_agg(p, ', ' ORDER BY i) AS methods FROM d GROUP BY 1), x AS (SELECT s.id, CASE WHEN regexp_full_match(doi, '10\\.\\d{{4,9}}/\\S+') THEN doi END AS doi, methods, price,
          CASE WHEN contains(lower(sensor), 'sentinel-1') OR contains(lower(sensor), 'ers') THEN CASE WHEN contains(lower(sensor), 'landsat') THEN 'Multi-sensor' ELSE 'SAR' END WHEN contains(lower(sensor), 'landsat') THEN 'Optical' ELSE nullif(trim(sensor), '') END AS sensor,
          coalesce(nullif(trim(c), ''), CASE WHEN contains(lower(text), 'prut') THEN 'Ukraine' WHEN contains(lower(text), 'vietnam') THEN 'Vietnam' END) AS country FROM s LEFT JOIN l ON l.id = s.id)
        SELECT id, doi, methods, sensor, country, (doi IS NOT NULL)::INT + (methods IS NOT NULL)::INT + (sensor IS NOT NULL)::INT + (country IS NOT NULL)::INT AS score FROM x WHERE (doi IS NOT NULL)::INT + (methods IS NOT NULL)::INT + (sensor IS NOT NULL)::INT + (country IS NOT NULL)::INT >= 3""",
)
def e_clean_chain(t: Tables) -> DataFrame:
    """Records cleaned, their fields normalised, places found in the text, scored, and kept from three known fields on."""
    k = F.col("o_orderkey")
    rows = t.orders.select(k.alias("id"), F.when(k % 3 == 0, "not a doi").otherwise(F.concat(F.lit("10.1234/x"), k.cast("string"))).alias("doi"), phrase(k, METHODS, ((1, 0),)).alias("methods"), phrase(k, SENSORS, ((3, 1),)).alias("sensor"), F.when(k % 2 == 0, "France").otherwise(" ").alias("country"), phrase(k, TEXTS, ((5, 2),)).alias("text"))
    rows = rows.withColumn("doi", F.when(F.col("doi").rlike(r"^10\.\d{4,9}/\S+$"), F.col("doi"))).withColumn("methods", X.canonical_list(F.col("methods"), NAMES)).withColumn("sensor", R.sensor_kind(F.col("sensor")))
    rows = rows.withColumn("country", F.coalesce(F.nullif(F.trim("country"), F.lit("")), R.first_word(F.col("text"), R.COUNTRY_RULES)))
    score = sum((F.col(c).isNotNull().cast("int") for c in ("doi", "methods", "sensor", "country")), F.lit(0))
    return rows.withColumn("score", score).filter("score >= 3").select("id", "doi", "methods", "sensor", "country", "score")


_CANDIDATES = """SELECT l_orderkey AS paper, CASE WHEN l_linenumber % 2 = 0 THEN 'accuracy' ELSE 'country' END AS field, CASE l_returnflag WHEN 'A' THEN 'text' WHEN 'R' THEN 'table' ELSE 'entities' END AS source, CASE WHEN l_quantity < 10 THEN NULL ELSE l_suppkey END AS value, l_discount AS confidence FROM lineitem"""


def _candidates(t: Tables) -> DataFrame:
    flag = F.col("l_returnflag")
    return t.lineitem.select(
        F.col("l_orderkey").alias("paper"), F.when(F.col("l_linenumber") % 2 == 0, "accuracy").otherwise("country").alias("field"), F.when(flag == "A", "text").when(flag == "R", "table").otherwise("entities").alias("source"),
        F.when(F.col("l_quantity") >= 10, F.col("l_suppkey")).alias("value"), F.col("l_discount").alias("confidence"),
    )


@query(
    "E35",
    f"""WITH c AS ({_CANDIDATES}), r AS (SELECT *, CASE source WHEN 'text' THEN 1 WHEN 'table' THEN 2 ELSE 3 END AS rank FROM c WHERE value IS NOT NULL), b AS (SELECT paper, field, first(value ORDER BY rank, confidence DESC, value) AS value, first(source ORDER BY rank) AS source, count(*) AS n_evidence FROM r GROUP BY 1, 2)
        SELECT * FROM b""",
)
def e_precedence_fill(t: Tables) -> DataFrame:
    """Fields filled from the first source that has a value; all candidates stay as evidence."""
    taken, evidence = X.filled_by_precedence(_candidates(t), "paper", "field", ["text", "table", "entities"])
    return taken.join(evidence.groupBy("paper", "field").agg(F.count("*").alias("n_evidence")), ["paper", "field"])


@query(
    "E28",
    """WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 1 - l_discount * 3 AS c, l_returnflag = 'R' AS weak, CASE WHEN l_suppkey % 3 = 0 THEN l_tax > 0.03 END AS accepted, 0.9 - l_tax AS vc FROM lineitem), g AS (SELECT *, round(c, 6) < 0.85 OR weak AS asked FROM r)
       SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, asked AS needs_judge, CASE WHEN asked AND accepted IS NOT NULL THEN accepted ELSE true END AS stays, round(CASE WHEN asked AND accepted IS NOT NULL THEN vc ELSE c END, 6)::DOUBLE AS confidence FROM g""",
)
def e_judge_gate(t: Tables) -> DataFrame:
    """Which records a judge is asked about, and what its verdicts do."""
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(1 - F.col("l_discount") * 3, 6).alias("confidence"), (F.col("l_returnflag") == "R").alias("weak"), F.when(F.col("l_suppkey") % 3 == 0, F.col("l_tax") > 0.03).alias("accepted"), (0.9 - F.col("l_tax")).alias("verdict_confidence"))
    return X.gated(rows, F.col("weak")).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "needs_judge", "stays", F.round("confidence", 6).alias("confidence"))


def _entities(t: Tables) -> DataFrame:
    return t.part.select(F.concat(F.lit("e."), F.col("p_partkey").cast("string")).alias("entity_id"), F.col("p_name").alias("name"), F.array("p_brand").alias("aliases"))


def _patches(t: Tables) -> DataFrame:
    """Targets of which some are missing; aliases that are new, a name in other letters, or known ones."""
    k = F.col("l_partkey")
    alias = F.when(F.col("l_linenumber") % 3 == 0, F.upper("p_name")).when(F.col("l_linenumber") % 3 == 1, F.col("p_brand")).otherwise(F.concat(F.lit("New "), F.col("l_suppkey").cast("string")))
    rows = t.lineitem.join(t.part.select("p_partkey", "p_name", "p_brand"), F.col("p_partkey") == k)
    return rows.select(F.concat(F.lit("e."), F.when(F.col("l_linenumber") == 7, k + 1_000_000).otherwise(k).cast("string")).alias("entity_id"), alias.alias("alias"))


_PATCHES_SQL = """e AS (SELECT 'e.' || p_partkey AS entity_id, p_name, p_brand FROM part), p AS (SELECT DISTINCT 'e.' || CASE WHEN l_linenumber = 7 THEN l_partkey + 1000000 ELSE l_partkey END AS entity_id, CASE l_linenumber % 3 WHEN 0 THEN upper(p_name) WHEN 1 THEN p_brand ELSE 'New ' || l_suppkey END AS alias, l_linenumber % 3 = 2 AS fresh FROM lineitem JOIN part ON p_partkey = l_partkey),
    o AS (SELECT p.entity_id, p.alias, CASE WHEN e.entity_id IS NULL THEN 'missing_target' WHEN fresh THEN 'added' ELSE 'duplicate' END AS outcome FROM p LEFT JOIN e ON e.entity_id = p.entity_id)"""


@query("O10", f"WITH {_PATCHES_SQL} SELECT entity_id, alias, outcome FROM o")
def o_alias_patches(t: Tables) -> DataFrame:
    """What becomes of each alias of a patch table."""
    return X.expanded(_entities(t), _patches(t))[1]


@query("O14", f"WITH {_PATCHES_SQL} SELECT DISTINCT entity_id, 'changed' AS how FROM o WHERE outcome = 'added' UNION ALL SELECT entity_id, 'removed' FROM e WHERE substr(entity_id, 3)::INT % 50 = 0 AND entity_id NOT IN (SELECT entity_id FROM o WHERE outcome = 'added')")
def o_refine_diff(t: Tables) -> DataFrame:
    """A registry before and after a staged refinement: aliases are added, then entities that got none and aren't wanted are left out."""
    before = _entities(t)
    after, told = X.expanded(before, _patches(t))
    number = F.substring("entity_id", 3, 20).cast("int")
    grown = told.filter("outcome = 'added'").select("entity_id").distinct().withColumn("_g", F.lit(True))
    after = after.join(grown, "entity_id", "left").filter(~((number % 50 == 0) & F.col("_g").isNull())).drop("_g")
    return X.changes(before, after, "entity_id")


@query(
    "O15",
    """WITH n AS (SELECT p_name, count(DISTINCT p_brand) AS aliases, avg(p_retailprice) AS mean FROM part GROUP BY 1) SELECT 'low_confidence' AS finding, l_partkey::VARCHAR AS subject, count(*) AS n FROM lineitem WHERE l_discount < 0.02 GROUP BY 2 HAVING count(*) >= 3 UNION ALL SELECT 'few_aliases', p_name, aliases FROM n WHERE aliases < 15
       UNION ALL SELECT 'generic_term', p_name, count(*) FROM part WHERE lower(split_part(p_name, ' ', 1)) IN ('new', 'old', 'small') GROUP BY 2""",
)
def o_registry_audit(t: Tables) -> DataFrame:
    """Entities often found with little confidence, names with few aliases, and names that begin with a word that says little."""
    low = t.lineitem.filter("l_discount < 0.02").groupBy(F.col("l_partkey").cast("string").alias("subject")).agg(F.count("*").alias("n")).filter("n >= 3")
    few = t.part.groupBy(F.col("p_name").alias("subject")).agg(F.count_distinct("p_brand").alias("n")).filter("n < 15")
    generic = t.part.filter(F.lower(F.split_part("p_name", F.lit(" "), F.lit(1))).isin("new", "old", "small")).groupBy(F.col("p_name").alias("subject")).agg(F.count("*").alias("n"))
    told = lambda rows, name: rows.select(F.lit(name).alias("finding"), "subject", "n")
    return told(low, "low_confidence").union(told(few, "few_aliases")).union(told(generic, "generic_term"))


DOMAINS = ("hydrology", "terrain_analysis", "flood_mapping", "remote_sensing", "law")


@query(
    "C2",
    f"""WITH s AS (SELECT p_partkey, p_type, {phrase_sql('p_partkey', DOMAINS, ((3, 1),))} AS d FROM part) SELECT p_partkey, CASE WHEN p_type IN ('LARGE', 'PROMO') THEN 'ML / AI' WHEN p_type = 'SMALL' THEN 'Terrain Analysis' ELSE CASE d WHEN 'hydrology' THEN 'Hydrological Models' WHEN 'terrain_analysis' THEN 'Terrain Analysis' WHEN 'flood_mapping' THEN 'Flood Mapping Methods' WHEN 'remote_sensing' THEN 'Image Processing' ELSE 'Other' END END AS family FROM s""",
)
def c_method_family(t: Tables) -> DataFrame:
    """Families of methods by lists that the caller gives, else by domain."""
    return t.part.select("p_partkey", X.method_family(F.col("p_type"), phrase(F.col("p_partkey"), DOMAINS, ((3, 1),)), {"ML / AI": ("LARGE", "PROMO"), "Terrain Analysis": ("SMALL",)}).alias("family"))
