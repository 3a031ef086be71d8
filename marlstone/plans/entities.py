"""Queries on entities and regions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import entities as E
from ..operators.density import stable_clusters
from ..operators.near_strings import near_pairs
from ..sources import tables as S
from .registry import Tables, query

_MENTIONS = """SELECT l_orderkey AS doc, p_name AS name, p_type AS canonical, l_discount * 10 AS pattern, l_tax * 10 AS context, l_quantity / 50 AS embedding, CASE WHEN l_returnflag = 'R' THEN 0.5 END AS llm, l_returnflag AS f FROM lineitem JOIN part ON p_partkey = l_partkey"""


@query(
    "E13 M9",
    f"""WITH m AS ({_MENTIONS}), s AS (SELECT doc, canonical, name, round(least(1, 0.3 * pattern + 0.3 * context + 0.2 * embedding + 0.2 * coalesce(llm, 0) + CASE f WHEN 'A' THEN 0.20 WHEN 'R' THEN 0.35 ELSE 0 END), 4) AS score FROM m WHERE name NOT IN ('hot plate', 'old rod')),
        r AS (SELECT *, row_number() OVER (PARTITION BY doc, canonical ORDER BY score DESC, name) AS rn FROM s WHERE score >= 0.3) SELECT doc, canonical, name, score::DOUBLE AS score FROM r WHERE rn = 1""",
)
def e_entity_scores(t: Tables) -> DataFrame:
    flag = F.col("l_returnflag")
    sections = F.when(flag == "A", F.array(F.lit("abstract"))).when(flag == "R", F.array(F.lit("methods"), F.lit("study_area"))).otherwise(F.array().cast("array<string>"))
    rows = t.lineitem.join(t.part.select("p_partkey", "p_name", "p_type"), F.col("p_partkey") == F.col("l_partkey")).select(
        F.col("l_orderkey").alias("doc"), F.col("p_name").alias("name"), F.col("p_type").alias("canonical"), (F.col("l_discount") * 10).alias("pattern"), (F.col("l_tax") * 10).alias("context"),
        (F.col("l_quantity") / 50).alias("embedding"), F.when(flag == "R", 0.5).alias("llm"), sections.alias("sections"),
    )
    return E.scored(rows, ["hot plate", "old rod"])


@query("X7 X6")
def x_best_context(t: Tables) -> DataFrame:
    """The stretch around a word with the most cues; tested against a plain version."""
    return t.documents.select("doc_id", E.best_context("text", " the ", ["ing", "tion", "ed "]).alias("context"))


@query(
    "C13",
    """SELECT p_partkey, CASE WHEN p_size % 6 = 0 THEN 'FORMULA_REGION' WHEN p_size % 6 = 1 THEN 'TABLE_REGION' WHEN p_size % 6 = 2 THEN 'MULTI_PANEL_FIGURE' WHEN p_size % 6 = 3 AND p_name LIKE 'red%' THEN 'CHART_REGION' WHEN p_size % 6 = 3 AND p_retailprice > 1300 THEN 'SCIENTIFIC_DIAGRAM' ELSE 'FIGURE_REGION' END AS region FROM part""",
)
def c_region_class(t: Tables) -> DataFrame:
    k = F.col("p_size") % 6
    arr = lambda *x: F.array(*[F.lit(v) for v in x])
    roles = F.when(k == 0, arr("formula", "table")).when(k == 1, arr("table")).when(k == 2, arr("graphic", "graphic")).when(k == 3, arr("figure")).otherwise(arr("text"))
    caption = F.when(F.col("p_name").startswith("red"), "Map of it").otherwise("Photo")
    rows = t.part.select("p_partkey", roles.alias("roles"), caption.alias("caption"), (F.col("p_retailprice") - 1000).alias("w"), F.lit(250).alias("h"))
    return rows.select("p_partkey", E.region_class("roles", "caption", F.col("w"), F.col("h")).alias("region"))


@query(
    "E41 F8",
    """SELECT page_id, CASE WHEN page_id % 50 = 0 THEN 'encrypted' WHEN length(html) > 9000 THEN 'too many pages' WHEN page_id % 4 = 3 THEN 'scanned' ELSE 'ok' END AS verdict FROM pages""",
)
def e_triage(t: Tables) -> DataFrame:
    long = F.when(F.length("html") > 9000, 501).otherwise(20)
    return t.pages.select("page_id", E.triage(F.col("page_id") % 50 == 0, long, F.lit(20), (F.col("page_id") % 4) * 5 + 0, F.length("html")).alias("verdict"))


@query(
    "E32 E10",
    """WITH h AS (SELECT doc_id, 'mail' AS metric, unnest(regexp_extract_all(text, '@mail([0-9]+)', 1)) AS raw FROM documents UNION ALL SELECT doc_id, 'percent', unnest(regexp_extract_all(text, '\\.([0-9]+)@', 1)) FROM documents), n AS (SELECT DISTINCT doc_id, raw FROM h WHERE metric = 'mail')
       SELECT DISTINCT h.doc_id, h.metric, h.raw, CASE WHEN h.metric = 'percent' THEN 0.5 ELSE 0.7 END::DOUBLE AS confidence FROM h LEFT JOIN n ON n.doc_id = h.doc_id AND n.raw = h.raw WHERE h.metric = 'mail' OR n.raw IS NULL""",
)
def e_metric_rows(t: Tables) -> DataFrame:
    return E.metric_rows(t.documents, "doc_id", "text", [("mail", "@mail([0-9]+)"), ("percent", r"\.([0-9]+)@")], "not reported")


@query(
    "E2 X15",
    """WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents) SELECT substr(sha1(doc_id::VARCHAR || ':p' || i), 1, 20) AS chunk_id, doc_id, i::INT AS place, md5(line) AS digest FROM l WHERE length(line) >= 20""",
)
def e_layout_chunks(t: Tables) -> DataFrame:
    return E.layout_chunks(t.documents, "doc_id", "text").select("chunk_id", "doc_id", "place", F.md5("chunk").alias("digest"))


@query(
    "E24 W5",
    """SELECT page_id, CASE WHEN html LIKE '%<table%' THEN 'table' WHEN html LIKE '%<img%' THEN 'figure' WHEN html LIKE '%<pre%' THEN 'equation' ELSE 'section' END AS kind, lag(page_id) OVER (PARTITION BY split_part(url, '/', 3) ORDER BY page_id) AS follows FROM pages""",
)
def e_typed_objects(t: Tables) -> DataFrame:
    html = F.col("html")
    kind = F.when(html.contains("<table"), "table").when(html.contains("<img"), "figure").when(html.contains("<pre"), "equation").otherwise("section")
    rows = t.pages.select(F.col("page_id").alias("id"), F.split_part("url", F.lit("/"), F.lit(3)).alias("host"), kind.alias("kind"))
    return E.numbered(rows, "host", "id").select(F.col("id").alias("page_id"), "kind", "follows")


@query(
    "E12",
    """WITH m AS (SELECT l_orderkey, list(DISTINCT p_type) AS m FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1) SELECT l_orderkey, a, b FROM m, (VALUES ('LARGE', 'SMALL'), ('PROMO', 'ECONOMY')) v(a, b) WHERE list_contains(m, a) AND list_contains(m, b)""",
)
def e_coupled_methods(t: Tables) -> DataFrame:
    m = t.lineitem.join(t.part, F.col("p_partkey") == F.col("l_partkey")).groupBy("l_orderkey").agg(F.collect_set("p_type").alias("m"))
    return E.coupled(m, "l_orderkey", "m", [("LARGE", "SMALL"), ("PROMO", "ECONOMY")])


@query(
    "O11",
    """SELECT DISTINCT p_name AS child, CASE WHEN p_name LIKE '%rod%' OR p_name LIKE '%plate%' THEN 'metalware' WHEN p_name LIKE 'red%' THEN 'coloured' END AS parent FROM part""",
)
def o_hierarchy(t: Tables) -> DataFrame:
    rules = t.spark.createDataFrame([("rod|plate", "metalware", 1), ("^red", "coloured", 2)], "pattern string, parent string, priority int")
    return E.hierarchy(t.part.select(F.col("p_name").alias("child")).distinct(), rules)


@query(
    "J17",
    """WITH s AS (SELECT s_suppkey, s_nationkey, CASE s_suppkey % 3 WHEN 0 THEN 0.9 WHEN 1 THEN 0.5 ELSE 0 END::DOUBLE AS score FROM supplier) SELECT s_suppkey, score, score > 0.4 AS accepted, CASE WHEN score > 0.4 THEN n_name END AS country FROM s LEFT JOIN nation ON n_nationkey = s_nationkey""",
)
def e_river_scores(t: Tables) -> DataFrame:
    k = F.col("s_suppkey") % 3
    rows = t.supplier.select("s_suppkey", "s_nationkey", F.when(k == 0, 0.9).when(k == 1, 0.5).otherwise(0.0).alias("score"))
    rows = rows.join(F.broadcast(t.nation.select("n_nationkey", "n_name")), F.col("n_nationkey") == F.col("s_nationkey"), "left")
    return rows.select("s_suppkey", "score", (F.col("score") > 0.4).alias("accepted"), F.when(F.col("score") > 0.4, F.col("n_name")).alias("country"))


@query(
    "O13",
    """SELECT lower(split_part(p_name, ' ', 2)) AS cluster, count(DISTINCT p_name) AS n_terms, count(*) AS n FROM part GROUP BY 1 HAVING count(DISTINCT p_name) >= 2""",
)
def o_gap_heads(t: Tables) -> DataFrame:
    """Unmatched terms gathered by their head word, two different ones or more."""
    head = F.lower(F.split_part("p_name", F.lit(" "), F.lit(2)))
    return t.part.groupBy(head.alias("cluster")).agg(F.countDistinct("p_name").alias("n_terms"), F.count("*").alias("n")).filter("n_terms >= 2")


@query("O13")
def o_gap_clusters(t: Tables) -> DataFrame:
    """Unmatched terms clustered by density, over all pairs of terms alike to 0.7 by edits: each term's cluster (its first term), how many it has, and the noise."""
    terms = t.part.select(F.lower(F.concat_ws(" ", "p_name", "p_type")).alias("term")).distinct()
    near = near_pairs(terms, "term", 8, 0.3)
    edges = near.select(F.xxhash64("a").alias("u"), F.xxhash64("b").alias("v"), "distance")
    found = stable_clusters(terms.select(F.xxhash64("term").alias("node")), edges, 2, 9)
    rows = terms.join(found, F.xxhash64("term") == F.col("node")).select("term", "cluster")
    per = rows.filter("cluster is not null").groupBy("cluster").agg(F.min("term").alias("label"), F.count("*").alias("size"))
    return rows.join(per, "cluster", "left").select("term", F.coalesce("label", F.lit("noise")).alias("label"), F.coalesce("size", F.lit(1)).alias("size"))


@query("S7", "SELECT n_name AS file, n_nationkey >= 20 AS fresh FROM nation WHERE n_nationkey >= 20 OR n_nationkey % 7 = 0")
def s_incremental_scan(t: Tables) -> DataFrame:
    """Files that a manifest doesn't list, or lists with another time: one file a nation, the first twenty listed, some of them with an older time."""
    place = S.new_place(t.spark, "inbox")
    t.nation.select("n_nationkey", F.col("n_name").alias("file")).write.partitionBy("file").json(place)
    pattern = f"{place}/file=*/*.json"
    name = F.regexp_extract("path", "file=([^/]+)/", 1)
    files = S.changed_files(t.spark, pattern, None).withColumn("file", name).join(t.nation.select("n_nationkey", F.col("n_name").alias("file")), "file")
    aged = F.when(F.col("n_nationkey") % 7 == 0, F.col("modified") - F.expr("interval 1 day")).otherwise(F.col("modified"))
    manifest = files.filter("n_nationkey < 20").select("path", aged.alias("modified"))
    changed = S.changed_files(t.spark, pattern, manifest).select("path").join(files, "path")
    return changed.select("file", (F.col("n_nationkey") >= 20).alias("fresh"))


@query("S22", "SELECT n_name AS pending FROM nation WHERE n_regionkey NOT IN (0, 1)")
def s_pending_inputs(t: Tables) -> DataFrame:
    """Inputs without an output yet, by the names of files in both folders."""
    inbox, outbox = S.new_place(t.spark, "inbox"), S.new_place(t.spark, "outbox")
    rows = t.nation.select("n_nationkey", "n_regionkey", F.col("n_name").alias("file"))
    rows.write.partitionBy("file").json(inbox)
    rows.filter("n_regionkey in (0, 1)").write.partitionBy("file").parquet(outbox)
    named = lambda place, ending: S.changed_files(t.spark, f"{place}/file=*/*.{ending}", None).select(F.regexp_extract("path", "file=([^/]+)/", 1).alias("pending"))
    return named(inbox, "json").join(named(outbox, "parquet"), "pending", "left_anti").distinct()
