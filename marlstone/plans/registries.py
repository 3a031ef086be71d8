"""Queries on facts with links and on a registry's checks, over rows derived from the driver's tables with a planted case for each rule."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import factbase as FB
from ..operators import registry_checks as RC
from .phrases import quoted
from .registry import Tables, query

SATELLITES = ("Sentinel-1", "MODIS", "Landsat-8", "HomeSat")
METHODS = ("random forest", "u-net", "thresholding")
METRICS = ("NSE", "RMSE")
TASKS = ("", "flood mapping", "forecasting", "calibration", "review")


def _pick(words, key: str) -> str:
    return f"[{', '.join(map(quoted, words))}][({key}) % {len(words)} + 1]"


def _of(words, key):
    return F.element_at(F.array(*map(F.lit, words)), (key % len(words) + 1).cast("int"))


_FACTS_SQL = f"""l AS (SELECT l_orderkey::VARCHAR AS paper_id, * FROM lineitem),
    e AS (
        SELECT paper_id, 'data_source' AS fact_type, {_pick(SATELLITES, 'l_suppkey')} AS name, NULL::DOUBLE AS value, NULL AS unit, CASE WHEN l_suppkey % 3 > 0 THEN 'abstract+methods' END AS section FROM l WHERE l_returnflag = 'A'
        UNION ALL SELECT paper_id, 'method', {_pick(METHODS, 'l_partkey')}, NULL, NULL, CASE WHEN l_partkey % 11 = 0 THEN 'introduction' WHEN l_partkey % 11 > 1 THEN 'methods' END FROM l WHERE l_returnflag = 'N'
        UNION ALL SELECT paper_id, 'result', {_pick(METRICS, 'l_linenumber')}, l_discount, '-', CASE WHEN l_partkey % 7 = 0 THEN 'abstract' ELSE 'results' END FROM l WHERE l_returnflag = 'R'
        UNION ALL SELECT o_orderkey::VARCHAR, 'study_area', n_name, NULL, NULL, 'abstract+introduction' FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey WHERE o_orderkey % 4 > 0
        UNION ALL SELECT o_orderkey::VARCHAR, 'task', {_pick(TASKS, 'o_orderkey')}, NULL, NULL, 'abstract' FROM orders WHERE o_orderkey % 5 > 0
        UNION ALL SELECT o_orderkey::VARCHAR, 'system_property', 'near_real_time', NULL, NULL, 'abstract+methods' FROM orders WHERE o_orderstatus = 'F'),
    f AS (SELECT md5(concat_ws('|', paper_id, fact_type, name, CASE WHEN value IS NULL THEN '' ELSE value::VARCHAR END, coalesce(unit, ''))) AS fact_id, paper_id, fact_type, name, value, count(DISTINCT section) AS n_evidence, list(DISTINCT section) AS sections
          FROM e GROUP BY ALL),
    k(src_type, dst_type) AS (VALUES ('result', 'method'), ('method', 'data_source'), ('method', 'study_area'), ('data_source', 'study_area'), ('task', 'method'), ('task', 'data_source'), ('task', 'study_area'), ('system_property', 'data_source'), ('system_property', 'method')),
    x AS (SELECT a.fact_id AS src, b.fact_id AS dst, a.fact_type AS src_type, b.fact_type AS dst_type FROM f a JOIN k ON k.src_type = a.fact_type JOIN f b ON b.paper_id = a.paper_id AND b.fact_type = k.dst_type)"""
_FACTS_SQL = _FACTS_SQL.replace("FROM e GROUP BY ALL)", "FROM e GROUP BY fact_id, paper_id, fact_type, name, value)")


def _facts(t: Tables) -> DataFrame:
    c, text = F.col, lambda key: F.when(key, F.lit("a stretch of text"))
    rows = t.lineitem.withColumn("paper_id", c("l_orderkey").cast("string"))
    section = lambda when, there, else_: F.when(when, F.lit(there)).otherwise(F.lit(else_))
    sources = rows.filter("l_returnflag = 'A'").select("paper_id", _of(SATELLITES, c("l_suppkey")).alias("name"), F.lit("any").alias("sensor_type"), text(c("l_suppkey") % 3 > 0).alias("snippet"))
    methods = rows.filter("l_returnflag = 'N'").select("paper_id", _of(METHODS, c("l_partkey")).alias("name"), F.lit(None).cast("string").alias("category"), section(c("l_partkey") % 11 == 0, "introduction", "methods").alias("section"), text(c("l_partkey") % 11 != 1).alias("snippet"))
    metrics = rows.filter("l_returnflag = 'R'").select("paper_id", _of(METRICS, c("l_linenumber")).alias("type"), c("l_discount").alias("value"), F.lit("-").alias("unit"), section(c("l_partkey") % 7 == 0, "abstract", "results").alias("section"), text(F.lit(True)).alias("snippet"))
    papers = t.orders.select(c("o_orderkey").alias("paper_id"), "o_custkey", "o_orderstatus")
    where = papers.filter("paper_id % 4 > 0").join(t.customer, c("c_custkey") == c("o_custkey")).join(t.nation, c("n_nationkey") == c("c_nationkey"))
    areas = where.select("paper_id", c("n_name").alias("country"), F.lit("").alias("region"), F.lit(None).cast("string").alias("river_basin"), text(F.lit(True)).alias("snippet"))
    tasks = papers.select("paper_id", _of(TASKS, c("paper_id")).alias("task"), text(F.lit(True)).alias("snippet"))
    live = papers.filter("o_orderstatus = 'F'").select("paper_id", F.lit("near_real_time").alias("value"), text(F.lit(True)).alias("snippet"))
    return FB.atomic_facts(sources, methods, metrics, areas, tasks, live)


@query(
    "E16",
    f"""WITH {_FACTS_SQL}, r AS (SELECT src, string_agg(dst, ',' ORDER BY dst) AS related FROM x GROUP BY 1)
        SELECT fact_id, paper_id, fact_type, name, value, n_evidence, coalesce(related, '') AS related,
               concat_ws(', ', CASE WHEN n_evidence = 0 THEN 'no evidence' END, CASE WHEN fact_type = 'data_source' AND name = 'HomeSat' AND n_evidence = 0 THEN 'unknown satellite without evidence' END,
                   CASE WHEN fact_type = 'method' AND n_evidence > 0 AND NOT list_contains(sections, 'methods') THEN 'evidence outside methods' END, CASE WHEN fact_type = 'result' AND NOT list_contains(sections, 'results') THEN 'evidence outside results' END) AS reasons
        FROM f LEFT JOIN r ON src = fact_id""",
)
def e_facts(t: Tables) -> DataFrame:
    """Facts of six kinds with what they rest on, and why some aren't accepted."""
    rows = _facts(t)
    return rows.select("fact_id", "paper_id", "fact_type", "name", "value", F.size("evidence").cast("long").alias("n_evidence"), F.array_join(F.array_sort("related_fact_ids"), ",").alias("related"), F.array_join("reasons", ", ").alias("reasons"))


@query(
    "G11",
    f"""WITH {_FACTS_SQL} SELECT src_type, dst_type, CASE WHEN src_type = 'result' THEN 'EVALUATES' WHEN src_type = 'method' AND dst_type = 'data_source' THEN 'APPLIED_TO' WHEN src_type = 'task' AND dst_type = 'method' THEN 'USES'
            WHEN src_type = 'system_property' AND dst_type = 'data_source' THEN 'RUNS_ON' ELSE 'RELATED_TO' END AS rel, count(*) AS n, count(DISTINCT src) AS n_src FROM x GROUP BY 1, 2, 3""",
)
def g_fact_graph(t: Tables) -> DataFrame:
    """The links of facts as typed edges, counted by the kinds of their ends."""
    return FB.fact_edges(_facts(t)).groupBy("src_type", "dst_type", "rel").agg(F.count("*").alias("n"), F.countDistinct("src").alias("n_src"))


_PREFIXES = (*RC.PREFIXES, "thing")
# by key: the id, and for each rule some keys that break it
_ID = "CASE WHEN {k} % 97 = 0 THEN 'Bad Id ' || ({k})::VARCHAR ELSE {p} || '.n' || ({k})::VARCHAR END"
_REGISTRY_SQL = f"""i AS (SELECT p_partkey AS k, {_ID.format(k='p_partkey', p=_pick(_PREFIXES, 'p_partkey'))} AS id FROM part),
    e AS (SELECT i.k, i.id, CASE WHEN i.k % 67 = 0 THEN '' WHEN i.k % 101 = 0 THEN NULL ELSE 'Name ' || (i.k % 1500)::VARCHAR END AS display_name,
            CASE WHEN i.k % 83 = 0 THEN NULL WHEN i.k % 71 = 0 THEN 'concept' ELSE replace(split_part(i.id, '.', 1), 'org', 'organization') END AS type,
            CASE WHEN i.k % 79 = 0 THEN [] ELSE list_filter(['alias ' || (i.k % 900)::VARCHAR, CASE WHEN i.k % 61 = 0 THEN i.id END, CASE WHEN i.k % 59 = 0 THEN 'name ' || (i.k % 1500)::VARCHAR END, CASE WHEN i.k % 53 = 0 THEN 'n' || (i.k + 1)::VARCHAR END], lambda x: x IS NOT NULL) END AS aliases,
            CASE WHEN i.k % 73 = 0 THEN 'method.none' WHEN i.k % 47 = 0 THEN b.id WHEN i.k % 47 = 1 THEN c.id WHEN i.k % 5 > 0 THEN a.id END AS parent_id, i.k % 7 = 0 AS is_generic
          FROM i LEFT JOIN i a ON a.k = i.k // 2 AND a.k <> i.k LEFT JOIN i b ON b.k = i.k + 1 LEFT JOIN i c ON c.k = i.k - 1)"""
_SLUG = "trim(regexp_replace(lower({0}), '[^a-z0-9]+', '_', 'g'), '_')"


def _registry(t: Tables) -> tuple[DataFrame, DataFrame]:
    c = F.col
    ids = t.part.select(c("p_partkey").alias("k")).withColumn("id", F.when(c("k") % 97 == 0, F.concat(F.lit("Bad Id "), c("k").cast("string"))).otherwise(F.concat(_of(_PREFIXES, c("k")), F.lit(".n"), c("k").cast("string"))))
    name = lambda word: F.concat(F.lit(word), (c("k") % 1500).cast("string"))
    aliases = F.array_compact(F.array(F.concat(F.lit("alias "), (c("k") % 900).cast("string")), F.when(c("k") % 61 == 0, c("id")), F.when(c("k") % 59 == 0, name("name ")), F.when(c("k") % 53 == 0, F.concat(F.lit("n"), (c("k") + 1).cast("string")))))
    rows = ids.select(
        "k", "id", F.when(c("k") % 67 == 0, "").when(c("k") % 101 == 0, F.lit(None)).otherwise(name("Name ")).alias("display_name"),
        F.when(c("k") % 83 == 0, F.lit(None)).when(c("k") % 71 == 0, "concept").otherwise(F.replace(F.substring_index("id", ".", 1), F.lit("org"), F.lit("organization"))).alias("type"),
        F.when(c("k") % 79 == 0, F.array().cast("array<string>")).otherwise(aliases).alias("aliases"),
        F.when(c("k") % 73 == 0, -1).when(c("k") % 47 == 0, c("k") + 1).when(c("k") % 47 == 1, c("k") - 1).when((c("k") % 5 > 0) & (c("k") > 0), F.floor(c("k") / 2)).alias("up"), (c("k") % 7 == 0).alias("is_generic"),
    )
    rows = rows.join(ids.select(c("k").alias("pk"), c("id").alias("pid")), c("up") == c("pk"), "left").withColumn("parent_id", F.when(c("up") == -1, "method.none").otherwise(c("pid"))).drop("up", "pk", "pid")
    return rows, rows.filter("k % 13 = 0").select("id")


@query(
    "O9",
    f"""WITH {_REGISTRY_SQL}, p(prefix, of) AS (VALUES {', '.join(f"({quoted(a)}, {quoted(b)})" for a, b in RC.PREFIXES.items())}), a AS (SELECT id, display_name, unnest(aliases) AS alias FROM e),
        d AS (SELECT id, coalesce(type, '') AS type, lower(trim(coalesce(display_name, ''))) AS name, count(*) OVER (PARTITION BY coalesce(type, ''), lower(trim(coalesce(display_name, '')))) AS n FROM e)
        SELECT 'V01' AS code, 'ERROR' AS level, id AS entity_id, unnest(list_filter([CASE WHEN coalesce(display_name, '') = '' THEN 'display_name' END, CASE WHEN type IS NULL THEN 'type' END, CASE WHEN len(aliases) = 0 THEN 'aliases' END], lambda x: x IS NOT NULL)) AS subject FROM e
        UNION ALL SELECT 'V02', 'ERROR', id, id FROM e WHERE NOT regexp_matches(id, '{RC.ID_FORM}')
        UNION ALL SELECT 'V03', 'WARNING', id, split_part(id, '.', 1) FROM e WHERE split_part(id, '.', 1) NOT IN (SELECT prefix FROM p)
        UNION ALL SELECT 'V03', 'ERROR', id, coalesce(type, 'nothing') || ' is not ' || of FROM e JOIN p ON prefix = split_part(id, '.', 1) WHERE type IS DISTINCT FROM of
        UNION ALL SELECT 'V04', 'ERROR', id, parent_id FROM e WHERE parent_id IS NOT NULL AND parent_id NOT IN (SELECT id FROM e)
        UNION ALL SELECT 'V05', 'ERROR', id, 'display_name' FROM e WHERE trim(coalesce(display_name, '')) = ''
        UNION ALL SELECT 'V06', 'WARNING', id, alias FROM a WHERE {_SLUG.format('alias')} IN ({_SLUG.format('id')}, {_SLUG.format("coalesce(display_name, '')")})
        UNION ALL SELECT 'V07', 'WARNING', id, id FROM e WHERE k % 13 = 0 AND NOT is_generic
        UNION ALL SELECT 'V08', 'WARNING', id, name FROM d WHERE n > 1""",
)
def o_violations(t: Tables) -> DataFrame:
    """What is wrong with single entities of a registry, by the codes V01 to V08."""
    return RC.violations(*_registry(t))


@query(
    "O8",
    rf"""WITH {_REGISTRY_SQL}, c AS (SELECT DISTINCT id, s AS slug FROM (SELECT id, unnest(list_concat([{_SLUG.format('id')}, {_SLUG.format("regexp_replace(id, '^[^.]*[.]', '')")}, {_SLUG.format("coalesce(display_name, '')")}], list_transform(aliases, lambda x: {_SLUG.format('x')}))) AS s FROM e) WHERE s <> ''),
        n AS (SELECT id, coalesce(type, 'unknown') AS type, {_SLUG.format("coalesce(display_name, '')")} AS slug FROM e), a AS (SELECT DISTINCT id, unnest(list_transform(aliases, lambda x: {_SLUG.format('x')})) AS slug FROM e)
        SELECT 'C01' AS code, 'ERROR' AS level, slug, id AS entity_id, n FROM (SELECT *, count(*) OVER (PARTITION BY slug) AS n FROM c) WHERE n > 1
        UNION ALL SELECT 'C02', 'WARNING', slug, id, n FROM (SELECT *, count(*) OVER (PARTITION BY type, slug) AS n FROM n WHERE slug <> '') WHERE n > 1
        UNION ALL SELECT 'C03', 'WARNING', {_SLUG.format("regexp_replace(e.id, '^[^.]*[.]', '')")}, e.id, count(*) FROM e JOIN a ON a.slug = {_SLUG.format("regexp_replace(e.id, '^[^.]*[.]', '')")} AND a.id <> e.id GROUP BY e.id""",
)
def o_collisions(t: Tables) -> DataFrame:
    """Entities that claim the same slug (C01), share a name within their type (C02) or have an id that is another one's alias (C03)."""
    return RC.collisions(_registry(t)[0])


@query(
    "O11",
    f"""WITH RECURSIVE {_REGISTRY_SQL}, w(id, at_, depth) AS (SELECT id, id, 0 FROM e UNION ALL SELECT w.id, p.id, depth + 1 FROM w JOIN e ON e.id = w.at_ JOIN e p ON p.id = e.parent_id WHERE depth < 60),
        r AS (SELECT w.id, w.at_ AS root, w.depth FROM w JOIN e ON e.id = w.at_ WHERE e.parent_id IS NULL OR e.parent_id NOT IN (SELECT id FROM e))
        SELECT e.id, root, depth::BIGINT AS depth, root IS NULL AS in_cycle FROM e LEFT JOIN r ON r.id = e.id""",
)
def o_hierarchy_roots(t: Tables) -> DataFrame:
    """Each entity's topmost ancestor and depth; those whose way up runs into a cycle have none."""
    return RC.hierarchy(_registry(t)[0])
