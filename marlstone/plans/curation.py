"""Queries on merged registries and their statistics, on judging and routing parses, and on whether tables conform to their schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import registry_merge as RM
from ..operators import routing as RO
from .phrases import quoted
from .registry import Tables, query

_KINDS = ("method", "sensor", "thing", "org", "data")
_ID = f"[{', '.join(map(quoted, _KINDS))}][p_partkey % {len(_KINDS)} + 1] || '.' || replace(p_name, ' ', '_') || (p_partkey % 40)::VARCHAR"
_FILES = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in RM.FILES.items())
_TYPES = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in RM.PREFIXES.items())


@query(
    "O7",
    f"""WITH s AS (SELECT p_partkey AS ord, {_ID} AS id, p_type AS type, CASE WHEN p_partkey % 5 > 0 THEN p_type || ' of ' || p_brand END AS definition, CASE WHEN p_partkey % 3 > 0 THEN p_type ELSE '' END AS domain, 'file' || (p_partkey % 7)::VARCHAR AS source,
            [p_brand, CASE WHEN p_size > 9 THEN upper(p_brand) END, ' ' || p_name] AS aliases, CASE WHEN p_partkey % 2 = 0 THEN [p_type, lower(p_type)] END AS related FROM part),
        i AS (SELECT id, 'sources' AS field, ord, 0 AS k, source AS x FROM s UNION ALL SELECT id, 'aliases', ord, unnest(range(1, 4)), unnest(aliases) FROM s UNION ALL SELECT id, 'related', ord, unnest(range(1, 3)), unnest(related) FROM s WHERE related IS NOT NULL),
        o AS (SELECT id, field, CASE WHEN field = 'sources' THEN x ELSE trim(lower(x)) END AS form, min(row(0, ord, k)) AS at_, arg_min(x, row(ord, k)) AS x FROM i WHERE x IS NOT NULL GROUP BY 1, 2, 3),
        p AS (SELECT p_partkey AS ord, {_ID} AS id, lower(p_brand) AS alias FROM part WHERE p_partkey % 9 = 0), n AS (SELECT id, alias, min(ord) AS ord FROM p WHERE row(id, alias) NOT IN (SELECT row(id, x) FROM o WHERE field = 'aliases') GROUP BY 1, 2),
        a AS (SELECT id, field, at_, x FROM o UNION ALL SELECT id, 'aliases', row(1, ord, 0), alias FROM n), g AS (SELECT id, {', '.join(f"coalesce(string_agg(x, '|' ORDER BY at_) FILTER (WHERE field = '{f}'), '') AS {f}" for f in ('sources', 'aliases', 'related'))} FROM a GROUP BY 1)
        SELECT id, CASE split_part(id, '.', 1) {_TYPES} ELSE arg_min(type, ord) END AS type, coalesce(arg_max(definition, row(length(definition), -ord)) FILTER (WHERE definition <> ''), '') AS definition, arg_min(domain, ord) FILTER (WHERE domain <> '') AS domain,
            any_value(g.sources) AS sources, any_value(g.aliases) AS aliases, any_value(g.related) AS related, CASE split_part(id, '.', 1) {_FILES} ELSE 'concepts' END AS file FROM s JOIN g USING (id) GROUP BY id""",
)
def o_registry_merged(t: Tables) -> DataFrame:
    """Entities of several sources in one registry: longest definitions, lists united, types by id, aliases patched in."""
    c, k = F.col, F.col("p_partkey")
    id_ = F.concat(F.element_at(F.array(*map(F.lit, _KINDS)), (k % len(_KINDS) + 1).cast("int")), F.lit("."), F.replace("p_name", F.lit(" "), F.lit("_")), (k % 40).cast("string"))
    sources = t.part.select(
        k.alias("ord"), id_.alias("id"), c("p_type").alias("type"), F.when(k % 5 > 0, F.concat_ws(" of ", "p_type", "p_brand")).alias("definition"), F.when(k % 3 > 0, c("p_type")).otherwise("").alias("domain"), F.concat(F.lit("file"), (k % 7).cast("string")).alias("source"),
        F.array(c("p_brand"), F.when(c("p_size") > 9, F.upper("p_brand")), F.concat(F.lit(" "), "p_name")).alias("aliases"), F.when(k % 2 == 0, F.array(c("p_type"), F.lower("p_type"))).alias("related"),
    )
    patched = t.part.filter("p_partkey % 9 = 0").select(k.alias("ord"), id_.alias("id"), F.lower("p_brand").alias("alias"))
    rows = RM.merged_sources(sources, ("aliases", "related"), patched)
    return rows.select("id", "type", "definition", "domain", *[F.array_join(f, "|").alias(f) for f in ("sources", "aliases", "related")], "file")


@query(
    "A26 O11",
    """WITH e AS (SELECT p_partkey AS k, 'm.' || p_partkey AS id, CASE WHEN p_partkey % 13 > 0 THEN p_type END AS type, CASE p_partkey % 3 WHEN 0 THEN p_brand WHEN 1 THEN '' END AS grp, CASE WHEN p_partkey % 4 > 0 THEN p_name ELSE ' ' END AS definition, CASE WHEN p_partkey % 6 > 0 THEN p_partkey % 6 - 1 ELSE 0 END AS n,
            CASE WHEN p_partkey % 8 > 0 THEN [p_brand, 'all'] END AS sources, CASE WHEN p_partkey % 17 = 0 THEN 'unknown' WHEN p_partkey % 5 > 0 THEN 'm.' || (p_partkey // 2) END AS parent, p_partkey % 10 = 0 AS generic FROM part),
        d AS (WITH RECURSIVE r(id, up, depth) AS (SELECT id, parent, CASE WHEN parent IS NULL THEN 0 ELSE 1 END FROM e UNION ALL SELECT r.id, e.parent, depth + 1 FROM r JOIN e ON e.id = r.up AND e.parent IS NOT NULL AND e.id <> r.id) SELECT id, max(depth) AS depth, bool_or(up = id) AS loops FROM r GROUP BY 1),
        x AS (SELECT 'entities' AS what, 'count' AS key, count(*) AS value FROM e UNION ALL SELECT 'entities', 'generic', count(*) FILTER (WHERE generic) FROM e
        UNION ALL SELECT 'definition', 'with', count(*) FILTER (WHERE trim(definition) <> '') FROM e UNION ALL SELECT 'definition', 'without', count(*) FILTER (WHERE trim(definition) = '') FROM e UNION ALL SELECT 'definition', 'percent', round(count(*) FILTER (WHERE trim(definition) <> '') / count(*) * 100, 1) FROM e
        UNION ALL SELECT 'aliases', unnest(['min', 'max', 'mean', 'median', 'none', 'all']), unnest([min(n), max(n), round(avg(n), 2), median(n), count(*) FILTER (WHERE n = 0), sum(n)]) FROM e
        UNION ALL SELECT 'type', coalesce(type, 'unknown'), count(*) FROM e GROUP BY 2 UNION ALL SELECT 'type_group', coalesce(nullif(grp, ''), 'unassigned'), count(*) FROM e GROUP BY 2 UNION ALL SELECT 'grouped', coalesce(type, 'unknown'), round(count(nullif(grp, '')) / count(*) * 100, 1) FROM e GROUP BY 2
        UNION ALL SELECT 'source', s, count(*) FROM (SELECT unnest(sources) AS s FROM e) GROUP BY 2 UNION ALL SELECT 'hierarchy', unnest(['roots', 'children', 'deepest']), unnest([count(*) FILTER (WHERE depth = 0), count(*) FILTER (WHERE depth > 0), max(depth)]) FROM d UNION ALL SELECT 'hierarchy', 'parents', count(DISTINCT parent) FROM e)
        SELECT what, key, value::DOUBLE AS value FROM x""",
)
def o_registry_statistics(t: Tables) -> DataFrame:
    """What a registry holds: by type, group and source, aliases, definitions, hierarchy."""
    c, k = F.col, F.col("p_partkey")
    id_ = lambda x: F.concat(F.lit("m."), x.cast("string"))
    entities = t.part.select(
        id_(k).alias("id"), F.when(k % 13 > 0, c("p_type")).alias("type"), F.when(k % 3 == 0, c("p_brand")).when(k % 3 == 1, "").alias("type_group"), F.when(k % 4 > 0, c("p_name")).otherwise(" ").alias("definition"),
        F.when(k % 6 > 0, F.slice(F.array(*[F.lit(x) for x in "abcde"]), F.lit(1), (k % 6 - 1).cast("int"))).alias("aliases"), F.when(k % 8 > 0, F.array("p_brand", F.lit("all"))).alias("sources"),
        F.when(k % 17 == 0, "unknown").when(k % 5 > 0, id_(F.floor(k / 2))).alias("parent_id"), (k % 10 == 0).alias("is_generic"),
    )
    return RM.statistics(entities)


_COUNTED = {"all_sections": "<h[1-6][ >]", "references": "href=", "citations": "<b>", "boxes": "<img", "formulas": "<pre", "tables": "<table", "figures": "<figure"}
_SCORE = " + ".join(f"CASE WHEN {cond} THEN {RO.WEIGHTS[k]} ELSE 0 END" for k, cond in {
    "title": "title <> ''", "abstract": "abstract <> ''", "structure": "sections >= 1", "three_sections": "all_sections >= 3", "references": "\"references\" >= 1", "citations": "citations >= 1", "coordinates": "boxes >= 1", "floats": "(figures >= 1 OR tables >= 1)"}.items())


@query(
    "E18 E20",
    f"""WITH p AS (SELECT page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title, regexp_extract(html, '(?s)<p><b>(.*?)</b>', 1) AS abstract, len(regexp_extract_all(html, '<p[ >]')) AS sections, {', '.join(f"len(regexp_extract_all(html, {quoted(p)})) AS " + '"' + k + '"' for k, p in _COUNTED.items())} FROM pages),
        q AS (SELECT page_id, round({_SCORE}, 3)::DOUBLE AS quality_score, sections >= 1 AS has_structure FROM p), s AS (SELECT *, has_structure AND quality_score >= {RO.USABLE_FROM} AS usable, page_id % 11 > 0 AS parsed, page_id % 5 = 0 OR page_id % 7 = 0 AS scanned FROM q),
        x AS (SELECT s.*, strategy, augment FROM s, (SELECT unnest([{', '.join(map(quoted, RO.STRATEGIES))}]) AS strategy), (SELECT unnest([true, false]) AS augment))
        SELECT page_id, strategy, augment, quality_score, usable, quality_score < {RO.ALONE_FROM} AS needs_second, r[1] AS route, r[2] AS reason FROM (SELECT *, CASE WHEN strategy = 'nougat_only' THEN row('second', 'asked for') WHEN strategy = 'grobid_only' THEN CASE WHEN parsed THEN row('first', 'asked for') ELSE row('none', 'not parsed') END
            WHEN strategy = 'hybrid' THEN row('both', 'asked for') WHEN strategy = 'auto' AND scanned THEN row('second', 'no text to parse') WHEN NOT parsed THEN row('both', 'not parsed') WHEN NOT usable THEN row('both', 'weak parse') WHEN augment THEN row('both', 'formulas added') ELSE row('first', 'good parse') END AS r FROM x)""",
)
def e_parser_routes(t: Tables) -> DataFrame:
    """Pages judged as parses by all eight weights, and where each strategy sends them."""
    counted = lambda p: F.size(F.regexp_extract_all("html", F.lit(p), F.lit(0)))
    parses = t.pages.select(
        F.col("page_id").alias("doc"), F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1).alias("title"), F.regexp_extract("html", "(?s)<p><b>(.*?)</b>", 1).alias("abstract"), counted("<p[ >]").alias("sections"), *[counted(p).alias(k) for k, p in _COUNTED.items()],
        F.lit(False).alias("has_second"),
    )
    doc = F.col("doc")
    judged = RO.document_quality(parses).withColumns({"parsed": doc % 11 > 0, "scanned": doc % 5 == 0, "has_text": doc % 7 > 0})
    each = judged.withColumn("strategy", F.explode(F.array(*map(F.lit, RO.STRATEGIES)))).withColumn("augment", F.explode(F.array(F.lit(True), F.lit(False))))
    return RO.routed(each, F.col("strategy"), F.col("augment")).select(doc.alias("page_id"), "strategy", "augment", "quality_score", "usable", "needs_second", "route", "reason")


@query(
    "EP2 F13",
    """SELECT 'documents' AS tab, 'error' AS level, 'missing column' AS issue, 'title' AS col, NULL::BIGINT AS n UNION ALL SELECT 'documents', 'error', 'type bigint for string', 'doc_id', NULL UNION ALL SELECT 'pages', 'error', 'unexpected column', 'html', NULL UNION ALL SELECT 'absent', 'error', 'absent', NULL, NULL
        UNION ALL SELECT 'nation', 'ok', 'rows', NULL, count(*) FROM nation UNION ALL SELECT 'no_labels', 'ok', 'rows', NULL, 0 UNION ALL SELECT 'no_labels', 'warning', 'empty', NULL, 0 UNION ALL SELECT 'ids', 'ok', 'rows', NULL, count(*) FROM orders
        UNION ALL SELECT 'ids', 'warning', 'null ids', 'canonical_id', count(*) FILTER (WHERE o_orderkey % 10 = 0) FROM orders""",
)
def v_conformance(t: Tables) -> DataFrame:
    """Tables against their schemas, with planted faults: missing and unexpected columns, a type, an absent and an empty table, null ids."""
    documents, pages = t.documents, t.pages
    said = {f.name: f.dataType for f in documents.schema} | {"doc_id": T.StringType(), "title": T.StringType()}
    ids = t.orders.select(F.when(F.col("o_orderkey") % 10 > 0, F.col("o_orderkey")).alias("canonical_id"), "o_custkey")
    tables = {"documents": documents, "pages": pages, "nation": t.nation, "no_labels": t.labels.filter("doc_id < 0"), "ids": ids}
    schemas = {"documents": T.StructType([T.StructField(k, v) for k, v in said.items()]), "pages": T.StructType([f for f in pages.schema if f.name != "html"]), "absent": T.StructType([]), "nation": t.nation.schema, "no_labels": t.labels.schema, "ids": ids.schema}
    return RO.conformance(tables, schemas, {"ids": ["canonical_id", "none"], "nation": ["n_nationkey"]}, ["no_labels", "nation"])
