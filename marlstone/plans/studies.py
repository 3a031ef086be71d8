"""Queries on merged parses, chunks in order, multi-query ranks, and what a graph of studies says of authors and countries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import parses as PA
from ..operators import vectors as V
from .registry import Tables, query
from .vectors import _TOP, _queries

_FORMULAS = ("E = m c^2", "e=mc^2", "", "Q = A v", "N S E", "nse")


def _parse(t: Tables, shift: int, every: int) -> DataFrame:
    k = F.col("c_custkey") + shift
    item = lambda x: F.element_at(F.array(*map(F.lit, _FORMULAS)), (x % len(_FORMULAS) + 1).cast("int"))
    rows = t.customer.filter((F.col("c_custkey") + shift) % every != 0)
    return rows.select(
        F.col("c_custkey").alias("paper_id"), F.when(k % 4 == 0, " ").otherwise(F.concat(F.lit(f"title {shift} "), k.cast("string"))).alias("title"), F.when(k % 3 > 0, F.concat(F.lit(f"abstract {shift} "), k.cast("string"))).alias("abstract"),
        F.when(k % 7 > 0, F.array(item(k), item(k + 3), item(k + 4))).alias("formulas"), F.when(k % 2 == 0, F.array(F.concat(F.lit(f"table {shift} "), k.cast("string")))).otherwise(F.array().cast("array<string>")).alias("tables"),
    )


def _parse_sql(shift: int, every: int) -> str:
    k, listed = f"(c_custkey + {shift})", "[" + ", ".join(f"'{x}'" for x in _FORMULAS) + "]"
    item = lambda d: f"{listed}[(({k} + {d}) % {len(_FORMULAS)} + 1)::INT]"
    return f"""SELECT c_custkey AS paper_id, CASE WHEN {k} % 4 = 0 THEN ' ' ELSE 'title {shift} ' || {k}::VARCHAR END AS title, CASE WHEN {k} % 3 > 0 THEN 'abstract {shift} ' || {k}::VARCHAR END AS abstract,
        CASE WHEN {k} % 7 > 0 THEN [{item(0)}, {item(3)}, {item(4)}] END AS formulas, CASE WHEN {k} % 2 = 0 THEN ['table {shift} ' || {k}::VARCHAR] ELSE []::VARCHAR[] END AS tables FROM customer WHERE {k} % {every} <> 0"""


@query(
    "E19",
    f"""WITH a AS ({_parse_sql(0, 5)}), b AS ({_parse_sql(1, 6)}), j AS (SELECT coalesce(a.paper_id, b.paper_id) AS paper_id, coalesce(nullif(trim(b.title), ''), nullif(trim(a.title), '')) AS title, coalesce(nullif(a.abstract, ''), nullif(b.abstract, '')) AS abstract,
            list_concat(coalesce(a.formulas, []), coalesce(b.formulas, [])) AS f, CASE WHEN len(coalesce(a.tables, [])) > 0 THEN a.tables ELSE b.tables END AS tables, CASE WHEN a.paper_id IS NULL THEN 'second' WHEN b.paper_id IS NULL THEN 'first' ELSE 'both' END AS sources FROM a FULL JOIN b ON a.paper_id = b.paper_id),
        u AS (SELECT paper_id, x, i, lower(replace(x, ' ', '')) AS p FROM (SELECT paper_id, unnest(f) AS x, unnest(range(1, len(f) + 1)) AS i FROM j)), g AS (SELECT paper_id, p, min(i) AS i, arg_min(x, i) AS x FROM u WHERE p <> '' GROUP BY 1, 2), l AS (SELECT paper_id, string_agg(x, '; ' ORDER BY i) AS formulas FROM g GROUP BY 1)
        SELECT j.paper_id, title, abstract, coalesce(formulas, '') AS formulas, coalesce(array_to_string(tables, '; '), '') AS tables, sources FROM j LEFT JOIN l ON l.paper_id = j.paper_id""",
)
def e_parses_merged(t: Tables) -> DataFrame:
    """Two parses of the same papers: the title of the second first, the abstract of the first, all formulas once, tables of the second only without any in the first."""
    rows = PA.merged(_parse(t, 0, 5), _parse(t, 1, 6), "paper_id", {"title": "second", "abstract": "first"})
    return rows.select("paper_id", "title", "abstract", F.array_join("formulas", "; ").alias("formulas"), F.coalesce(F.array_join("tables", "; "), F.lit("")).alias("tables"), "sources")


@query("V5 W6", "SELECT lang AS file, doc_id % 30 AS page, doc_id AS chunk_id, (row_number() OVER (PARTITION BY lang ORDER BY doc_id % 30, doc_id) - 1)::INT AS place FROM documents")
def v_ordered_chunks(t: Tables) -> DataFrame:
    """All chunks of each file by page and id, with their places. Pages are summed up first, so that no file's chunks come together in one task."""
    rows = t.documents.select(F.col("lang").alias("file"), (F.col("doc_id") % 30).alias("page"), F.col("doc_id").alias("chunk_id"))
    pages = rows.groupBy("file", "page").agg(F.count("*").alias("n"))
    ahead = pages.withColumn("ahead", F.sum("n").over(Window.partitionBy("file").orderBy("page")) - F.col("n")).select(F.col("file").alias("f"), F.col("page").alias("p"), "ahead")
    placed = rows.join(ahead, F.col("file").eqNullSafe(F.col("f")) & (F.col("page") == F.col("p")))
    place = F.row_number().over(Window.partitionBy("file", "page").orderBy("chunk_id")) - 1 + F.col("ahead")
    return placed.select("file", "page", "chunk_id", place.cast("int").alias("place"))


@query(
    "V2 M8",
    f"""SELECT id, label, round(0.85 * s + least(0.15, 0.15 * ln(1 + id % 700) / ln(501)), 6) AS score FROM (SELECT id, label, arg_min(sim, query) AS s FROM ({_TOP}) WHERE rank <= 10 GROUP BY 1, 2)""",
)
def v_multi_query(t: Tables) -> DataFrame:
    """Hits of several queries, each chunk once by its first query's hit, ranked by .85 of its similarity and a boost that grows with the logarithm of its citations."""
    hits = V.nearest(t.embeddings, _queries(t), 10).groupBy("id").agg(F.min_by("similarity", "query").alias("s"))
    boost = F.least(F.lit(0.15), 0.15 * F.log1p(F.col("id") % 700) / F.log1p(F.lit(500)))
    return hits.join(t.embeddings.select(F.col("vec_id").alias("id"), "label"), "id").select("id", "label", F.round(0.85 * F.col("s") + boost, 6).alias("score"))


@query(
    "V9",
    """WITH p AS (SELECT embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id = 0) SELECT label AS region, round(max(list_cosine_similarity(embedding::DOUBLE[], p.e)), 6) AS score, count(*) AS n FROM embeddings, p WHERE vec_id > 0 GROUP BY 1""",
)
def v_region_context(t: Tables) -> DataFrame:
    """A region's score is the best of its mentions' against the sentence that tells a study area."""
    told = t.embeddings.filter("vec_id = 0").select(F.col("embedding").alias("e"))
    rows = t.embeddings.filter("vec_id > 0").join(F.broadcast(told))
    return rows.groupBy(F.col("label").alias("region")).agg(F.round(F.max(V.cosine(F.col("embedding"), F.col("e"))), 6).alias("score"), F.count("*").alias("n"))


_OF = "FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey"


@query("G8", f"SELECT c_custkey AS author, count(DISTINCT o_orderkey) AS n_papers, count(DISTINCT p_brand) AS n_methods {_OF} GROUP BY 1 ORDER BY 2 DESC, 3 DESC, 1 LIMIT 20")
def g_top_authors(t: Tables) -> DataFrame:
    """The authors of most papers, with how many methods they use (a top-k report)."""
    rows = t.orders.select("o_orderkey", "o_custkey").join(t.lineitem.select("l_orderkey", "l_partkey"), F.col("l_orderkey") == F.col("o_orderkey")).join(t.part.select("p_partkey", "p_brand"), F.col("p_partkey") == F.col("l_partkey"))
    per = rows.groupBy(F.col("o_custkey").alias("author")).agg(F.countDistinct("o_orderkey").alias("n_papers"), F.countDistinct("p_brand").alias("n_methods"))
    return per.orderBy(F.desc("n_papers"), F.desc("n_methods"), "author").limit(20)


@query(
    "G8 W4",
    f"""WITH c AS (SELECT n_name AS country, p_type AS topic, count(DISTINCT o_orderkey) AS n {_OF} GROUP BY 1, 2) SELECT country, arg_max(topic, row(n, -ascii(topic), topic)) AS topic, max(n) AS n, round(max(n) / sum(n), 6) AS share FROM c GROUP BY 1""",
)
def g_country_dominance(t: Tables) -> DataFrame:
    """Each country's commonest topic and its share."""
    papers = t.orders.select("o_orderkey", "o_custkey").join(t.customer.select("c_custkey", "c_nationkey"), F.col("c_custkey") == F.col("o_custkey")).join(t.nation.select("n_nationkey", "n_name"), F.col("n_nationkey") == F.col("c_nationkey"))
    topics = t.lineitem.select("l_orderkey", "l_partkey").join(t.part.select("p_partkey", "p_type"), F.col("p_partkey") == F.col("l_partkey")).select("l_orderkey", "p_type").distinct()
    c = papers.join(topics, F.col("l_orderkey") == F.col("o_orderkey")).groupBy(F.col("n_name").alias("country"), F.col("p_type").alias("topic")).agg(F.count("*").alias("n"))
    return c.groupBy("country").agg(F.max_by("topic", F.struct(F.col("n"), -F.ascii("topic"), F.col("topic"))).alias("topic"), F.max("n").alias("n"), F.round(F.max("n") / F.sum("n"), 6).alias("share"))


@query(
    "G9",
    f"""SELECT 'topic' AS kind, * FROM (SELECT p_type AS name, count(DISTINCT o_orderkey) AS n {_OF} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10) UNION ALL SELECT 'method', * FROM (SELECT p_brand, count(DISTINCT o_orderkey) AS n {_OF} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10)
        UNION ALL SELECT 'country', * FROM (SELECT n_name, count(DISTINCT o_orderkey) AS n {_OF} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10)""",
)
def g_top_lists(t: Tables) -> DataFrame:
    """The graph's commonest topics, methods and countries (top-k reports)."""
    lines = t.lineitem.select("l_orderkey", "l_partkey").join(t.part.select("p_partkey", "p_type", "p_brand"), F.col("p_partkey") == F.col("l_partkey"))
    where = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey").join(t.customer.select("c_custkey", "c_nationkey"), F.col("c_custkey") == F.col("o_custkey")).join(t.nation.select("n_nationkey", "n_name"), F.col("n_nationkey") == F.col("c_nationkey"))
    where = where.join(t.lineitem.select("l_orderkey").distinct(), "l_orderkey", "left_semi")
    top = lambda kind, rows, name: rows.groupBy(F.col(name).alias("name")).agg(F.countDistinct("l_orderkey").alias("n")).orderBy(F.desc("n"), "name").limit(10).select(F.lit(kind).alias("kind"), "name", "n")
    return top("topic", lines, "p_type").union(top("method", lines, "p_brand")).union(top("country", where, "n_name"))
