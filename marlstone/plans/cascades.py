"""Queries that decide by rules first and by vectors last."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import cascade as C
from .phrases import phrase, phrase_sql, quoted, table_sql
from .registry import Tables, query

HEADINGS = ("A review of methods", "Mapping of water", "An overview of sensors", "Flood and rain", "Plain notes")
BODIES = ("we applied it", "on a global scale", "with previous studies", "at multiple locations", "of the whole country", "without more", "by flood extent", "as ever", "in words", "and so on")
_HEADS, _BODY = ((1, 0),), ((3, 1), (7, 2))
_TEXTS = f"t AS (SELECT vec_id AS text_id, {phrase_sql('vec_id', HEADINGS, _HEADS)} AS heading, {phrase_sql('vec_id', HEADINGS, _HEADS)} || ' ' || {phrase_sql('vec_id', BODIES, _BODY)} AS body, embedding AS vec FROM embeddings)"


def _any(column: str, words) -> str:
    return f"(len(list_filter([{', '.join(map(quoted, words))}], lambda x_: contains(lower({column}), x_))) > 0)"


_FLOOD = f"({_any('body', ('flood',))} AND {_any('body', C.FLOOD_CASE)})"
_CASE = f"""CASE WHEN {_any('heading', C.REVIEW)} AND NOT ({_FLOOD} OR {_any('body', C.GENERAL_CASE)}) THEN 0 WHEN {_any('body', C.MULTI_SITE)} THEN 1 WHEN {_FLOOD} THEN 2
    WHEN {_any('body', C.REGIONAL)} AND NOT {_any('body', C.GENERAL_CASE)} THEN 3 WHEN {_any('body', C.GENERAL_CASE)} THEN 4 WHEN {_any('body', C.GLOBAL)} THEN 5 END"""
_TOLD = (("review", 0.95, "rules_title_abstract"), ("multi_site", 0.88, "rules"), ("case_study", 0.92, "rules_flood_case"), ("regional", 0.88, "rules"), ("case_study", 0.9, "rules"), ("global_algorithmic", 0.85, "rules"))


@query(
    "C6 V8",
    f"""WITH {_TEXTS}, d AS (SELECT text_id, {_CASE} AS rule, {_any('body', C.WEAK_REVIEW)} AS weak FROM t), k AS (SELECT * FROM {table_sql('label, confidence, source', _TOLD)}),
        u AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE / sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]))) AS e FROM embeddings),
        m AS (SELECT label, i, avg(e[i]) AS x FROM u, range(1, 65) r(i) WHERE vec_id % 20 = 0 GROUP BY 1, 2), p AS (SELECT label, list(x ORDER BY i) AS mean FROM m GROUP BY 1),
        s AS (SELECT text_id, weak, 'type ' || p.label::VARCHAR AS label, round(list_dot_product(mean, e), 9) AS score FROM d JOIN u ON vec_id = text_id, p WHERE rule IS NULL AND text_id % 9 > 0),
        b AS (SELECT text_id, any_value(weak) AS weak, max(score) AS score, min(label) FILTER (score = top) AS label FROM (SELECT *, max(score) OVER (PARTITION BY text_id) AS top FROM s) GROUP BY 1)
        SELECT text_id, label, confidence::DOUBLE AS confidence, source, rule = 5 AND weak AS needs_judge FROM d JOIN k ON k.ord = rule
        UNION ALL SELECT d.text_id, coalesce(label, 'unknown'), coalesce(round(score, 6), 0.4), CASE WHEN label IS NULL THEN 'no_vector' ELSE 'vectors' END, label IS NULL OR score < {C.SURE} OR d.weak FROM d LEFT JOIN b ON b.text_id = d.text_id WHERE rule IS NULL""",
)
def c_study_cascade(t: Tables) -> DataFrame:
    """The type of a study by rules in order; only what they leave open meets the vectors of the prototypes."""
    key = F.col("vec_id")
    texts = t.embeddings.select(key.alias("text_id"), phrase(key, HEADINGS, _HEADS).alias("heading"), F.concat_ws(" ", phrase(key, HEADINGS, _HEADS), phrase(key, BODIES, _BODY)).alias("body"))
    vectors = t.embeddings.filter("vec_id % 9 > 0").select(key.alias("text_id"), F.col("embedding").alias("vec"))
    prototypes = t.embeddings.filter("vec_id % 20 = 0").select(F.concat(F.lit("type "), F.col("label").cast("string")).alias("label"), F.col("embedding").alias("vec"))
    return C.study_types(texts, vectors, prototypes).withColumn("confidence", F.round("confidence", 6))


# entities: id, name, aliases, type; the vector of each is that of the embedding with ten times its place
ENTITIES = (
    ("method.random_forest", "Random Forest", ("RF", "forest of trees"), "method"), ("sensor.modis", "MODIS", ("Terra imager",), "sensor"), ("metric.rmse", "RMSE", ("root error",), "metric"),
    ("sensor.rf", "Radio Frequency", ("radio",), "sensor"), ("data.dem", "Elevation Model", ("DEM", "heights"), "data"), ("concept.swat_team", "SWAT team", (), "concept"), ("method.swat", "SWAT model", ("swat basin model",), "method"),
)
NAMES = (" metric.rmse ", "RF", "SWAT", "heights", "Elevation model", "terra imager", "nothing known", "method.none", "")
TYPES = (None, "method", "sensor", "data", None)
CONTEXTS = (None, "the basin and its runoff", "police and basin", "police alone", "plain words")
_SENSES = (("SWAT", "SWAT model", 0, ("basin", "runoff"), ("police",), False), ("SWAT", "SWAT team", 1, ("police",), ("runoff",), False))


def _item(words, key: str) -> str:
    return f"[{', '.join('NULL' if w is None else quoted(w) for w in words)}][(({key}) % {len(words)}) + 1]"


_SLUG = "trim(regexp_replace(lower({0}), '[^a-z0-9]+', '_', 'g'), '_')"
_HITS = "greatest(0, (SELECT count(*) FROM (SELECT unnest({0}) AS w) WHERE contains(lower(context), w)) - (SELECT count(*) FROM (SELECT unnest({1}) AS w) WHERE contains(lower(context), w)))"


@query(
    "O2 V6",
    f"""WITH m AS (SELECT vec_id AS mention_id, {_item(NAMES, 'vec_id')} AS name, {_item(TYPES, 'vec_id // 3')} AS expected, {_item(CONTEXTS, 'vec_id // 2')} AS context, embedding::DOUBLE[] AS vec FROM embeddings),
        e(ord, entity_id, name, aliases, type) AS (VALUES {', '.join(f"({k}, {quoted(i)}, {quoted(n)}, [{', '.join(map(quoted, a))}]::VARCHAR[], {quoted(y)})" for k, (i, n, a, y) in enumerate(ENTITIES))}),
        al AS (SELECT alias, arg_max(entity_id, ord) AS entity_id, arg_max(type, ord) AS type FROM (SELECT ord, entity_id, type, {_SLUG.format("unnest(list_concat([entity_id, regexp_replace(entity_id, '^[^.]*[.]', ''), name], aliases))")} AS alias FROM e) GROUP BY 1),
        a0 AS (SELECT mention_id, entity_id FROM m JOIN e ON e.entity_id = trim(m.name) WHERE coalesce(expected = type, true)),
        h AS (SELECT mention_id, {_HITS.format("['basin', 'runoff']", "['police']")} AS model, {_HITS.format("['police']", "['runoff']")} AS team FROM m WHERE name = 'SWAT' AND context IS NOT NULL),
        a1 AS (SELECT mention_id, CASE WHEN model >= team THEN 'method.swat' ELSE 'concept.swat_team' END AS entity_id FROM h WHERE greatest(model, team) > 0),
        a2 AS (SELECT mention_id, entity_id FROM m JOIN al ON alias = {_SLUG.format('m.name')} WHERE coalesce(expected = type, true)),
        a3 AS (SELECT mention_id, arg_min(entity_id, ord) AS entity_id FROM m JOIN e ON lower(trim(m.name)) = lower(e.name) WHERE coalesce(expected = type, true) GROUP BY 1),
        n AS (SELECT mention_id, e.entity_id, round(list_cosine_similarity(vec, b.embedding::DOUBLE[]), 9) AS s, e.ord FROM m, e JOIN embeddings b ON b.vec_id = e.ord * 10 WHERE coalesce(expected = type, true)),
        a4 AS (SELECT mention_id, arg_min(entity_id, row(-s, ord)) AS entity_id, round(max(s), 6) AS s FROM n GROUP BY 1 HAVING max(s) >= {C.LIKE})
        SELECT m.mention_id, coalesce(a0.entity_id, a1.entity_id, a2.entity_id, a3.entity_id, a4.entity_id) AS entity_id,
               CASE WHEN a0.entity_id IS NOT NULL THEN 'alias' WHEN a1.entity_id IS NOT NULL THEN 'disambiguation' WHEN a2.entity_id IS NOT NULL THEN 'alias' WHEN a3.entity_id IS NOT NULL THEN 'exact' WHEN a4.entity_id IS NOT NULL THEN 'semantic' ELSE 'unknown' END AS match,
               CASE WHEN a0.entity_id IS NOT NULL THEN 1.0 WHEN a1.entity_id IS NOT NULL THEN 0.95 WHEN a2.entity_id IS NOT NULL OR a3.entity_id IS NOT NULL THEN 1.0 ELSE coalesce(s, 0) END::DOUBLE AS confidence
        FROM m LEFT JOIN a0 USING (mention_id) LEFT JOIN a1 USING (mention_id) LEFT JOIN a2 USING (mention_id) LEFT JOIN a3 USING (mention_id) LEFT JOIN a4 USING (mention_id)""",
)
def o_resolve_cascade(t: Tables) -> DataFrame:
    """Mentions to entities: the id itself, the sense that the context tells, an alias, the displayed name, the nearest vector, or unknown."""
    key = F.col("vec_id")
    item = lambda words, k: F.element_at(F.array(*map(F.lit, words)), (F.pmod(k, F.lit(len(words))) + 1).cast("int"))
    mentions = t.embeddings.select(key.alias("mention_id"), item(NAMES, key).alias("name"), item(TYPES, F.floor(key / 3)).alias("expected_type"), item(CONTEXTS, F.floor(key / 2)).alias("context"), F.col("embedding").alias("vec"))
    entities = t.spark.createDataFrame([(k, i, n, list(a), y) for k, (i, n, a, y) in enumerate(ENTITIES)], "ord int, entity_id string, name string, aliases array<string>, type string")
    senses = t.spark.createDataFrame([(n, s, k, list(a), list(b), f) for n, s, k, a, b, f in _SENSES], "name string, sense string, ord int, signals array<string>, excludes array<string>, fallback boolean")
    vectors = t.embeddings.filter(f"vec_id % 10 = 0 and vec_id < {10 * len(ENTITIES)}").select((key / 10).cast("int").alias("ord"), F.col("embedding").alias("vec"))
    return C.resolved(mentions, entities, senses, vectors)
