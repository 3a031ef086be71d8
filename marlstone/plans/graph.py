"""Queries on graphs as node and edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import graphs as G
from .registry import Tables, query

_EDGES_SQL = "SELECT src, dst FROM (SELECT o_orderkey AS src, lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS dst FROM orders) WHERE dst IS NOT NULL"


def _edges(t: Tables) -> DataFrame:
    """Each order refers to the next one of its customer."""
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return t.orders.select(F.col("o_orderkey").alias("src"), F.lead("o_orderkey").over(w).alias("dst")).filter("dst is not null")


@query(
    "G1 G2 S18",
    """SELECT l_orderkey AS src, l_partkey AS dst, 'CONTAINS' AS rel, min(l_linenumber) AS first_line, round(max(l_discount), 4) AS confidence FROM lineitem GROUP BY 1, 2""",
)
def g_edges_deduplicated(t: Tables) -> DataFrame:
    return t.lineitem.groupBy(F.col("l_orderkey").alias("src"), F.col("l_partkey").alias("dst")).agg(
        F.lit("CONTAINS").alias("rel"), F.min("l_linenumber").alias("first_line"), F.round(F.max("l_discount"), 4).alias("confidence")
    )


@query(
    "G3",
    """WITH n AS (SELECT o_orderkey AS id FROM orders WHERE o_orderstatus <> 'P'), e AS (SELECT DISTINCT l_orderkey AS dst FROM lineitem) SELECT id, false AS is_stub FROM n UNION ALL SELECT dst, true FROM e WHERE dst NOT IN (SELECT id FROM n)""",
)
def g_stub_edges(t: Tables) -> DataFrame:
    nodes = t.orders.filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("id"))
    return G.with_stubs(t.lineitem.select(F.col("l_orderkey").alias("dst")), nodes)


@query(
    "G4 U1",
    f"""WITH RECURSIVE e AS ({_EDGES_SQL}), b AS (SELECT src, dst FROM e UNION SELECT dst, src FROM e), s AS (SELECT o_orderkey AS id FROM orders WHERE o_orderkey % 100 = 0),
        p AS (SELECT id AS start, id AS node, 0 AS hops FROM s UNION SELECT p.start, b.dst, p.hops + 1 FROM p JOIN b ON b.src = p.node WHERE p.hops < 3) SELECT start, node, min(hops) AS hops FROM p GROUP BY 1, 2 HAVING min(hops) > 0""",
)
def g_k_hop(t: Tables) -> DataFrame:
    return G.reached(_edges(t), t.orders.filter("o_orderkey % 100 = 0").select(F.col("o_orderkey").alias("id")), 3, both=True)


@query(
    "G6",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_discount FROM lineitem WHERE l_discount >= 0.07 ORDER BY l_discount DESC, l_orderkey, l_linenumber, l_partkey LIMIT 100""",
)
def g_confident_edges(t: Tables) -> DataFrame:
    return t.lineitem.filter("l_discount >= 0.07").orderBy(F.desc("l_discount"), "l_orderkey", "l_linenumber", "l_partkey").limit(100).select("l_orderkey", "l_linenumber", "l_partkey", "l_discount")


@query(
    "G8 G10 C1",
    """WITH m AS (SELECT year(o_orderdate)::INT AS yr, p_type, count(DISTINCT o_orderkey) AS n FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey GROUP BY 1, 2) SELECT yr, p_type, n, n - lag(n) OVER (PARTITION BY p_type ORDER BY yr) AS change FROM m""",
)
def g_topic_evolution(t: Tables) -> DataFrame:
    rows = t.lineitem.join(t.part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey")).join(t.orders.select("o_orderkey", F.year("o_orderdate").alias("yr")), F.col("l_orderkey") == F.col("o_orderkey"))
    m = rows.groupBy("yr", "p_type").agg(F.countDistinct("o_orderkey").alias("n"))
    return m.withColumn("change", F.col("n") - F.lag("n").over(Window.partitionBy("p_type").orderBy("yr")))


@query(
    "G8",
    """SELECT n_name, count(DISTINCT c_custkey) AS n_authors, count(*) AS n_papers, round(sum(o_totalprice), 2) AS total FROM nation JOIN customer ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey GROUP BY 1 ORDER BY n_papers DESC, n_name LIMIT 20""",
)
def g_top_countries(t: Tables) -> DataFrame:
    per = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("s"))
    rows = per.join(t.customer.select("c_custkey", "c_nationkey"), F.col("c_custkey") == F.col("o_custkey")).join(F.broadcast(t.nation), F.col("n_nationkey") == F.col("c_nationkey"))
    out = rows.groupBy("n_name").agg(F.count("*").alias("n_authors"), F.sum("n").alias("n_papers"), F.round(F.sum("s"), 2).alias("total"))
    return out.orderBy(F.desc("n_papers"), "n_name").limit(20)


@query(
    "G9",
    """SELECT 'Order' AS kind, count(*) AS n FROM orders UNION ALL SELECT 'Customer', count(*) FROM customer UNION ALL SELECT 'Part', count(*) FROM part UNION ALL SELECT 'CONTAINS', count(*) FROM lineitem UNION ALL SELECT 'PLACED', count(*) FROM orders""",
)
def g_summary(t: Tables) -> DataFrame:
    n = lambda kind, df: df.agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n")
    return n("Order", t.orders).union(n("Customer", t.customer)).union(n("Part", t.part)).union(n("CONTAINS", t.lineitem)).union(n("PLACED", t.orders))


@query(
    "A1",
    """SELECT a.l_orderkey AS fact_of, a.l_returnflag AS src_type, b.l_returnflag AS dst_type, count(*) AS n FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_returnflag = 'R' AND b.l_returnflag <> 'R' GROUP BY 1, 2, 3""",
)
def g_fact_links(t: Tables) -> DataFrame:
    # pairs are counted from the two groups' sizes; they aren't made
    per = t.lineitem.groupBy(F.col("l_orderkey").alias("fact_of"), "l_returnflag").agg(F.count("*").alias("k"))
    a = per.filter("l_returnflag = 'R'").select("fact_of", F.col("l_returnflag").alias("src_type"), F.col("k").alias("ka"))
    b = per.filter("l_returnflag <> 'R'").select("fact_of", F.col("l_returnflag").alias("dst_type"), F.col("k").alias("kb"))
    return a.join(b, "fact_of").select("fact_of", "src_type", "dst_type", (F.col("ka") * F.col("kb")).alias("n"))


@query("E21")
def g_region_merge(t: Tables) -> DataFrame:
    """Boxes of parts on a page of their size, merged while they touch; iterative, so without SQL. Tested against a plain version."""
    i = F.col("p_partkey")
    boxes = t.part.select(i.alias("id"), F.col("p_size").alias("page"), (i % 400).cast("double").alias("x0"), (i % 230).cast("double").alias("y0"), (i % 400 + 30).cast("double").alias("x1"), (i % 230 + 20).cast("double").alias("y1"))
    return G.merged(boxes, "page")
