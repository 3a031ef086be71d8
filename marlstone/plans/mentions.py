"""Queries on what mentions in texts say together. Texts are put together from stretches by the order's or customer's key, the same in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import mentions as M
from .phrases import phrase, phrase_sql, quoted, table_sql
from .registry import Tables, query

STRETCHES = ("HEC-HMS runs", "is coupled with", "LISFLOOD and", "a 2D model", "SWAT", "linked to the", "in one-dimensional flow", "random forest for", "flood mapping of", "a long stretch of words that tells nothing at all of models", "1D and 2D", "combined with", "rainfall runoff", "MIKE 21")
_PICKS = ((1, 0), (3, 1), (5, 2), (9, 4), (11, 3))
MODELS = (("HEC HMS", "HEC-HMS"), ("LISFLOOD", "LISFLOOD"), ("SWAT", "SWAT"), ("MIKE 21", "MIKE-21"))
TASKS = (("flood mapping", "flood_mapping", 0.92), ("rainfall runoff", "rainfall_runoff_modeling", 0.88))
METHODS = (("random forest", "RF", "flood_mapping"), ("SWAT", "SWAT", "rainfall_runoff_modeling"))
WINDOW = 12
_TEXTS = f"t AS (SELECT c_custkey AS text_id, {phrase_sql('c_custkey', STRETCHES, _PICKS)} AS text FROM customer)"


def _texts(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("text_id"), phrase(F.col("c_custkey"), STRETCHES, _PICKS).alias("text"))


def _hits(name: str, rows: str, columns: str) -> str:
    """A subquery of all places of phrases as whole words, hyphens standing for spaces; the phrases don't overlap."""
    low = "replace(lower(text), '-', ' ')"
    return f"""{name} AS (SELECT text_id, {columns}, i - 1 AS start, i - 1 + len(phrase) AS upto FROM t, {rows}, range(1, 400) r(i) WHERE i + len(phrase) <= len(text) + 1 AND substr({low}, i, len(phrase)) = lower(phrase)
        AND NOT regexp_matches(CASE WHEN i = 1 THEN ' ' ELSE substr(text, i - 1, 1) END, '[A-Za-z0-9]') AND NOT regexp_matches(substr(text || ' ', i + len(phrase), 1), '[A-Za-z0-9]'))"""


_COUPLED = f"""{_hits('h', table_sql('phrase, name', MODELS), 'name')}, {_hits('c', table_sql('phrase, cue', [(x, x) for x in M.COUPLERS]), 'cue')},
    b AS (SELECT c.text_id, c.cue, c.start AS at_, c.upto AS past, (SELECT max(row(h.start, h.upto, h.name)) FROM h WHERE h.text_id = c.text_id AND h.start < c.start) AS a, (SELECT min(row(h.start, h.upto, h.name)) FROM h WHERE h.text_id = c.text_id AND h.start > c.start) AS z FROM c),
    p AS (SELECT text_id, a[3] AS model_a, z[3] AS model_b, cue, a[1]::INT AS start, z[2]::INT AS "end" FROM b WHERE a IS NOT NULL AND z IS NOT NULL AND at_ - a[2] <= {WINDOW} AND z[1] - past <= {WINDOW} AND a[3] <> z[3])"""


def _models(t: Tables) -> DataFrame:
    return t.spark.createDataFrame(list(MODELS), "phrase string, name string")


@query("E11 E12", f"WITH {_TEXTS}, {_COUPLED} SELECT * FROM p")
def e_couplings(t: Tables) -> DataFrame:
    """Pairs of models with a coupling word between them, near both, with their characters."""
    return M.couplings(_texts(t), _models(t), WINDOW)


@query(
    "E11",
    f"""WITH {_TEXTS}, {_COUPLED}, {_hits('k', table_sql('phrase, task, confidence', TASKS), 'task, confidence')}, {_hits('m', table_sql('phrase, name, task', METHODS), 'task')},
        e AS (SELECT text_id, task, confidence::DOUBLE AS confidence, CASE WHEN confidence > 0.9 THEN 'text_phrase' ELSE 'text_keyword' END AS source FROM k UNION ALL SELECT text_id, task, 0.85, 'method_task_field' FROM m UNION ALL SELECT text_id, 'flood_inundation_mapping', 0.88, 'coupling_context' FROM p)
        SELECT text_id, task, max(confidence)::DOUBLE AS confidence, arg_max(source, row(confidence, source)) AS source FROM e GROUP BY 1, 2""",
)
def e_tasks(t: Tables) -> DataFrame:
    """Tasks of a text by phrases, keywords, the methods it names and couplings, each by its best evidence."""
    texts = _texts(t)
    phrases = t.spark.createDataFrame(list(TASKS), "phrase string, task string, confidence double")
    methods = t.spark.createDataFrame(list(METHODS), "phrase string, name string, task string")
    return M.tasks(texts, phrases, methods, M.couplings(texts, _models(t), WINDOW))


_HAS = [f"regexp_matches(text, {quoted(p)})" for _, p in M.DIMENSIONS]


@query(
    "E11",
    f"""WITH {_TEXTS} SELECT text_id, array_to_string(list_sort(list_filter([CASE WHEN {_HAS[0]} THEN '1D' END, CASE WHEN {_HAS[1]} THEN '2D' END, CASE WHEN {_HAS[2]} THEN '3D' END, CASE WHEN {_HAS[3]} OR ({_HAS[0]} AND {_HAS[1]}) THEN 'coupled_1D_2D' END], lambda x: x IS NOT NULL)), ',') AS dimensions FROM t""",
)
def e_dimensions(t: Tables) -> DataFrame:
    return M.dimensions(_texts(t)).select("text_id", F.array_join("dimensions", ",").alias("dimensions"))


KINDS = ("figure", "table", "equation", "margin")
_CAPTION = ((3, 1), (5, 2), (1, 4))
ENTITIES = (("HEC HMS", "method.hec_hms"), ("SWAT", "method.swat"), ("flood mapping", "concept.flood"), ("random forest", "method.rf"), ("2D model", "concept.twod"), ("SWAT runs", "method.swat"))


@query(
    "G12",
    f"""WITH t AS (SELECT o_orderkey AS text_id, o_custkey AS paper, {phrase_sql('o_orderkey', STRETCHES, _CAPTION)} AS text, list_extract([{', '.join(map(quoted, KINDS))}], (o_orderkey % 4 + 1)::INT) AS kind FROM orders),
        {_hits('h', table_sql('phrase, canonical_id', ENTITIES), 'kind, canonical_id')}, g(kind, has, names) AS (VALUES {', '.join(f"({quoted(k)}, {quoted(a)}, {quoted(b)})" for k, (a, b) in M.GROUNDS.items())})
        SELECT 'p' || paper::VARCHAR AS src, has AS rel, 'r' || text_id::VARCHAR AS dst, NULL::INT AS start, NULL::INT AS "end" FROM t JOIN g USING (kind)
        UNION ALL SELECT 'r' || text_id::VARCHAR, any_value(names), canonical_id, min(start)::INT, arg_min(upto, start)::INT FROM h JOIN g USING (kind) GROUP BY text_id, canonical_id""",
)
def g_region_graph(t: Tables) -> DataFrame:
    """Papers, their figures, tables and equations, and the entities that captions name, with the first place of each."""
    key = F.col("o_orderkey")
    kind = F.element_at(F.array(*map(F.lit, KINDS)), (key % 4 + 1).cast("int"))
    regions = t.orders.select(F.concat(F.lit("r"), key.cast("string")).alias("region_id"), F.concat(F.lit("p"), F.col("o_custkey").cast("string")).alias("paper_id"), kind.alias("kind"), phrase(key, STRETCHES, _CAPTION).alias("caption"))
    return M.region_graph(regions, t.spark.createDataFrame(list(ENTITIES), "phrase string, canonical_id string"))


@query(
    "J20",
    r"""WITH s AS (SELECT doc_id, string_split(regexp_replace(text, '([.!?])\s+(\p{Lu})', '\1' || chr(1) || '\2', 'g'), chr(1)) AS s FROM documents WHERE text IS NOT NULL), r AS (SELECT doc_id, unnest(s) AS sentence, (unnest(range(1, len(s) + 1)) - 1)::INT AS ord FROM s),
        n AS (SELECT doc_id, unnest(['of the', 'the of', 'and that']) AS name FROM documents), m AS (SELECT r.doc_id, name, ord, CASE WHEN contains(lower(sentence), name) THEN 0 WHEN contains(lower(sentence), split_part(name, ' ', 1)) AND contains(lower(sentence), split_part(name, ' ', 2)) THEN 1 END AS rank FROM r JOIN n USING (doc_id))
        SELECT doc_id, name, min(row(rank, ord))[2]::INT AS ord, CASE WHEN min(rank) = 0 THEN 'exact' ELSE 'partial' END AS match FROM m WHERE rank IS NOT NULL GROUP BY 1, 2""",
)
def j_first_sentence(t: Tables) -> DataFrame:
    """The sentence of each document that names a phrase first, as it stands or by its words."""
    pieces = X.sentences(F.col("text"))
    rows = t.documents.filter("text is not null").select(F.col("doc_id").alias("text_id"), F.posexplode(pieces).alias("ord", "sentence"))
    names = t.documents.select(F.col("doc_id").alias("text_id"), F.explode(F.array(*map(F.lit, ("of the", "the of", "and that")))).alias("name"))
    return M.first_sentences(rows, names).withColumnRenamed("text_id", "doc_id")
