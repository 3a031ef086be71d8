"""Queries on methods used in texts and on the chain that decides on entities. Texts are lines of `documents` or stretches put together by a key, the same in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import checks as C
from ..operators import entity_chain as EC
from ..operators import methods as ME
from ..operators.entities import ACCEPT_FROM, SECTION_BOOST
from .mentions import _hits
from .phrases import phrase, phrase_sql, quoted, table_sql
from .registry import Tables, query

STRETCHES = (
    "we used HEC-HMS", "and LISFLOOD was applied", "which previous studies describe", "an LSTM network", "wavelet transforms", "coupled with", "a long stretch of words that tells nothing at all of models", "obtained by SWAT", "linked  to", "WA-LSTM is employed",
    "Gumbel plots are used",
)
_PICKS = ((1, 0), (3, 1), (5, 2), (7, 4), (9, 3), (2, 5))
AROUND = 30
# name, category, subcategory, dimension, tasks, partners, components
REGISTRY = (
    ("HEC-HMS", "physical_based", "hydrological", "1D", ["flood_forecasting"], ["LISFLOOD", "SWAT"], None), ("LISFLOOD", None, "hydrodynamic", "2D", [], None, None), ("SWAT", None, "hydrological", "1D", None, ["LISFLOOD", "SWAT-X"], []),
    ("LSTM", "machine_learning", None, None, ["other"], [], None), ("WA-LSTM", "hybrid", "wavelet_ml", None, None, None, ["wavelet", "LSTM"]), ("wavelet transform", "signal", None, None, None, None, None),
)
PHRASES = (("HEC HMS", "HEC-HMS"), ("LISFLOOD", "LISFLOOD"), ("SWAT", "SWAT"), ("an LSTM", "LSTM"), ("WA LSTM", "WA-LSTM"), ("wavelet transforms", "wavelet transform"), ("Gumbel plots", "slope plot"))


def _texts(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("text_id"), phrase(F.col("c_custkey"), STRETCHES, _PICKS).alias("text"))


def _registry(t: Tables) -> DataFrame:
    return t.spark.createDataFrame(list(REGISTRY), "name string, category string, subcategory string, dimension string, tasks array<string>, partners array<string>, components array<string>")


def _used(t: Tables) -> DataFrame:
    return ME.used_methods(_texts(t), t.spark.createDataFrame(list(PHRASES), "phrase string, name string"), AROUND)


def _listed(words) -> str:
    return "[" + ", ".join(map(quoted, words)) + "]"


def _any_sql(of: str, words) -> str:
    return f"len(list_filter({_listed(words)}, lambda w_: contains({of}, w_))) > 0"


_cell = lambda x: "NULL" if x is None else _listed(x) + "::VARCHAR[]" if isinstance(x, list) else quoted(x)
_REGISTRY = "reg(name, category, subcategory, dimension, tasks, partners, components) AS (VALUES " + ", ".join("(" + ", ".join(map(_cell, r)) + ")" for r in REGISTRY) + ")"
_USED = f"""t AS (SELECT c_custkey AS text_id, {phrase_sql('c_custkey', STRETCHES, _PICKS)} AS text FROM customer), {_hits('h', table_sql('phrase, name', PHRASES), 'name, text')},
    x AS (SELECT text_id, name, start AS at_, trim(regexp_replace(substr(text, greatest(start - {AROUND}, 0) + 1, upto + {AROUND} - greatest(start - {AROUND}, 0)), '\\s+', ' ', 'g')) AS c FROM h),
    u AS (SELECT text_id, name, min(at_)::INT AS at_, arg_min(c, at_) AS evidence FROM x WHERE {_any_sql('lower(c)', C.USED)} AND NOT ({_any_sql('lower(c)', C.SPOKEN_OF)}) GROUP BY 1, 2), {_REGISTRY}"""


def _cases(of: str, table: dict[str, str]) -> str:
    return f"CASE {of} " + " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in table.items()) + " END"


@query("E12 E9 E33", f'WITH {_USED} SELECT text_id, name, at_ AS "at", evidence, 0.88::DOUBLE AS confidence FROM u')
def e_used_methods(t: Tables) -> DataFrame:
    """Methods that a text uses, each by its first place with a cue of use and none of being only spoken of."""
    return _used(t)


@query(
    "E12",
    f"""WITH {_USED}, r AS (SELECT u.text_id, u.name, category, tasks FROM u LEFT JOIN reg USING (name)), told AS (SELECT text_id, {_cases('category', ME.BY_CATEGORY)} AS w FROM r UNION ALL SELECT text_id, {_cases('task', ME.BY_TASK)} FROM (SELECT text_id, unnest(tasks) AS task FROM r)),
        guess AS (SELECT text_id, w FROM r, (VALUES {', '.join(f"({quoted(w)}, {_listed(parts)})" for w, parts in ME.BY_NAME.items())}) k(w, parts) WHERE len(list_filter(parts, lambda p_: contains(lower(name), p_))) > 0),
        a AS (SELECT text_id, w FROM told WHERE w IS NOT NULL UNION ALL SELECT text_id, w FROM guess WHERE text_id NOT IN (SELECT text_id FROM told WHERE w IS NOT NULL)) SELECT text_id, string_agg(DISTINCT w, ',' ORDER BY w) AS pipelines FROM a GROUP BY 1""",
)
def e_implied_work(t: Tables) -> DataFrame:
    """The work that a text's methods stand for, by the registry, else by parts of their names."""
    return ME.implied_work(_used(t), _registry(t)).select("text_id", F.array_join("pipelines", ",").alias("pipelines"))


@query(
    "E12",
    f"""WITH {_USED}, w AS (SELECT text_id FROM t WHERE {_any_sql("lower(regexp_replace(text, '\\s+', ' ', 'g'))", ME.CHAINING)}), m AS (SELECT u.text_id, reg.* FROM u JOIN reg USING (name) WHERE u.text_id IN (SELECT text_id FROM w)), p AS (SELECT *, unnest(partners) AS partner FROM m)
        SELECT p.text_id, p.name AS model_a, m.name AS model_b, CASE WHEN p.subcategory = 'hydrological' AND m.subcategory = 'hydrodynamic' THEN 'hydrological_hydrodynamic' WHEN p.dimension = '1D' AND m.dimension = '2D' THEN '1D_2D' ELSE 'detected' END AS coupling_type
        FROM p JOIN m ON m.text_id = p.text_id AND m.name = p.partner""",
)
def e_known_couplings(t: Tables) -> DataFrame:
    """Models of a text that the registry calls partners, where the text couples."""
    return ME.known_couplings(_texts(t), _used(t), _registry(t))


@query(
    "E12",
    f"""WITH {_USED} SELECT text_id, name, subcategory, array_to_string(components, ',') AS components, 'registry' AS source FROM u JOIN reg USING (name) WHERE category = 'hybrid'
        UNION ALL SELECT text_id, 'wavelet_ml_hybrid_inferred', 'wavelet_ml', string_agg(name, ',' ORDER BY name), 'inferred' FROM u GROUP BY text_id HAVING bool_or({_any_sql('lower(name)', ME.WAVELETS)}) AND bool_or({_any_sql('lower(name)', ME.LEARNERS)})""",
)
def e_hybrids(t: Tables) -> DataFrame:
    """Hybrid methods of a text, listed or inferred from a wavelet and a learner."""
    return ME.hybrids(_used(t), _registry(t)).withColumn("components", F.array_join("components", ","))


TOLD = ("the SCS curve number was applied", "SMA by soil moisture accounting", "a study area in the basin", "SCS of a convention", "data sources and ground truth", "used for flood events", "LSTM", "plain words only", "an scs analysis")
_ABSTRACT, _METHODS, _OTHER = ((1, 0), (3, 1)), ((5, 2), (2, 7), (4, 3)), ((7, 5), (8, 1))
# name, canonical, pattern
ENTITIES = (("SCS", "method.scs", 0.88), (" SMA ", "", 0.5), ("LSTM", "method.lstm", 0.88), ("lstm", "Method.LSTM", 0.6), ("the", "concept.the", 0.2), ("data", "concept.data", 0.9), ("m", "concept.m", 0.9), ("soil moisture", None, 0.1))
SENSES = (("SCS", "method.curve_number", 0, ["curve number", "runoff"], ["convention"], False), ("SCS", "org.scs", 1, ["convention"], [], False), ("SMA", "method.sma", 0, ["soil"], [], True))
_BOOSTS = " + ".join(f"CASE WHEN contains(lower({s}), lower(name)) THEN {w} ELSE 0 END" for s, w in SECTION_BOOST.items() if s in ("abstract", "methods", "conclusion"))
_SENSES = "(VALUES " + ", ".join(f"({quoted(n)}, {quoted(s)}, {o}, {_listed(a)}, {_listed(x)}::VARCHAR[], {str(f).lower()})" for n, s, o, a, x, f in SENSES) + ") s(name, sense, ord, signals, excludes, fallback)"


@query(
    "E13 E14 X7 M9",
    f"""WITH d AS (SELECT doc_id AS doc, string_split(text, chr(10)) AS p, doc_id FROM documents), s AS (SELECT doc, coalesce(p[1], '') AS title, concat_ws(' ', p[2], {phrase_sql('doc_id', TOLD, _ABSTRACT)}) AS abstract, concat_ws(' ', p[3], {phrase_sql('doc_id', TOLD, _METHODS)}) AS methods,
            concat_ws(' ', array_to_string(p[4:], ' '), {phrase_sql('doc_id', TOLD, _OTHER)}) AS conclusion FROM d), w AS (SELECT *, concat_ws(' ', abstract, methods, conclusion) AS text FROM s),
        e AS (SELECT w.*, trim(name) AS name, canonical, pattern::DOUBLE AS pattern, doc % 5 / 5.0::DOUBLE AS embedding, CASE WHEN doc % 3 = 0 THEN 0.5 END AS llm FROM w, {table_sql('name, canonical, pattern', ENTITIES)} WHERE length(trim(name)) > 1 AND upper(trim(name)) NOT IN ({', '.join(map(quoted, EC.BLOCKED))})),
        b AS (SELECT *, CASE WHEN contains(lower(title), lower(name)) THEN {EC.TITLE_BOOST} ELSE 0 END + {_BOOSTS} AS boost, string_split(lower(text), lower(name)) AS parts FROM e),
        k AS (SELECT doc, name, canonical, text, parts, unnest(range(1, least(len(parts) - 1, {EC.PLACES}) + 1)) AS k FROM b), a AS (SELECT *, list_sum(list_transform(parts[1:k], lambda x_: length(x_)))::BIGINT + (k - 1) * length(name) AS at_ FROM k),
        c AS (SELECT doc, name, canonical, k, trim(regexp_replace(substr(text, greatest(at_ - {EC.AROUND}, 0) + 1, at_ + length(name) + {EC.AROUND} - greatest(at_ - {EC.AROUND}, 0)), '\\s+', ' ', 'g')) AS ctx FROM a),
        f AS (SELECT doc, name, arg_min(ctx, row(-len(list_filter({_listed(EC.CONTEXT_CUES)}, lambda w_: contains(lower(ctx), w_))), k)) AS ctx FROM c GROUP BY 1, 2),
        g AS (SELECT b.*, coalesce(ctx, '') AS ctx, CASE WHEN {_any_sql("lower(coalesce(ctx, ''))", EC.PLACE_CUES)} THEN 0.5 ELSE 0 END + CASE WHEN {_any_sql("lower(coalesce(ctx, ''))", EC.USE_CUES)} THEN 0.3 ELSE 0 END AS context FROM b LEFT JOIN f USING (doc, name)),
        q AS (SELECT g.doc, g.name, sense, ord, fallback, greatest(0, len(list_filter(signals, lambda w_: contains(lower(ctx), w_))) - len(list_filter(excludes, lambda w_: contains(lower(ctx), w_)))) AS hits FROM g JOIN {_SENSES} ON s.name = g.name),
        m AS (SELECT doc, name, CASE WHEN max(hits) > 0 THEN first(sense ORDER BY hits DESC, ord) ELSE max(sense) FILTER (WHERE fallback) END AS sense FROM q GROUP BY 1, 2),
        r AS (SELECT g.doc, g.name, coalesce(sense, canonical) AS canonical, context, ctx, CASE WHEN {_any_sql('lower(ctx)', EC.ROLE_CUES)} THEN 'used' ELSE 'mentioned' END AS role,
            least(1, round(round(0.3 * pattern + 0.3 * context + 0.2 * embedding + 0.2 * coalesce(llm, 0), 4) + boost, 4))::DOUBLE AS score FROM g LEFT JOIN m ON m.doc = g.doc AND m.name = g.name),
        z AS (SELECT *, row_number() OVER v AS rn, lead(ctx) OVER v AS alt FROM r WHERE coalesce(canonical, '') <> '' WINDOW v AS (PARTITION BY doc, lower(canonical) ORDER BY score DESC, name, ctx))
        SELECT doc, name, canonical, role, context::DOUBLE AS context_score, score, score >= {ACCEPT_FROM} AS accepted, md5(ctx) AS evidence, md5(alt) AS alt_evidence FROM z WHERE rn = 1
        UNION ALL SELECT doc, name, canonical, role, context::DOUBLE, score, score >= {ACCEPT_FROM}, md5(ctx), NULL FROM r WHERE coalesce(canonical, '') = ''""",
)
def e_entity_chain(t: Tables) -> DataFrame:
    """Entities of all documents through the whole chain: blocked, told by their best context, given a sense, scored, once for each canonical name."""
    key, part = F.col("doc_id"), F.split("text", "\n")
    rest = F.array_join(F.slice(part, F.lit(4), F.greatest(F.size(part) - 3, F.lit(0))), " ")
    told = {"abstract": F.concat_ws(" ", F.get(part, F.lit(1)), phrase(key, TOLD, _ABSTRACT)), "methods": F.concat_ws(" ", F.get(part, F.lit(2)), phrase(key, TOLD, _METHODS)), "conclusion": F.concat_ws(" ", rest, phrase(key, TOLD, _OTHER))}
    documents = t.documents.select(key.alias("doc"), F.get(part, F.lit(0)).alias("title"), F.create_map(*[x for k, v in told.items() for x in (F.lit(k), v)]).alias("sections"))
    listed = F.array(*[F.struct(F.lit(n).cast("string").alias("name"), F.lit(c).cast("string").alias("canonical"), F.lit(p).alias("pattern")) for n, c, p in ENTITIES])
    entities = t.documents.select(key.alias("doc"), F.explode(listed).alias("e")).select("doc", "e.*", (F.col("doc") % 5 / 5).alias("embedding"), F.when(F.col("doc") % 3 == 0, 0.5).alias("llm"))
    senses = t.spark.createDataFrame(list(SENSES), "name string, sense string, ord int, signals array<string>, excludes array<string>, fallback boolean")
    rows = EC.chained(entities, documents, senses)
    return rows.withColumn("evidence", F.md5("evidence")).withColumn("alt_evidence", F.md5("alt_evidence"))
