"""Queries on the property graph: orders stand for papers, their customers' segments and nations for topics and countries, types and brands of their parts for methods and sensors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import property_graph as G
from .registry import Tables, query

TOPIC, SENSORS, METHODS = "BUILD", ("Brand#11", "Brand#12", "Brand#13"), ("LARGE", "PROMO")


def graph(t: Tables) -> tuple[DataFrame, DataFrame]:
    papers = t.orders.join(t.customer, F.col("c_custkey") == F.col("o_custkey")).join(F.broadcast(t.nation), F.col("n_nationkey") == F.col("c_nationkey"))
    parts = t.lineitem.join(t.part, F.col("p_partkey") == F.col("l_partkey"))
    paper = ("Paper", F.col("o_orderkey"))
    of_line = ("Paper", F.col("l_orderkey"))
    return G.derived([
        G.Phase("WRITTEN_BY", papers, paper, ("Author", F.col("o_custkey"))), G.Phase("HAS_TOPIC", papers, paper, ("Topic", F.col("c_mktsegment"))), G.Phase("FROM_COUNTRY", papers, paper, ("Country", F.col("n_name"))),
        G.Phase("USES_METHOD", parts, of_line, ("Method", F.col("p_type")), F.col("l_discount")), G.Phase("USES_SENSOR", parts, of_line, ("Sensor", F.col("p_brand")), F.col("l_tax")),
    ])


_EDGES = """papers AS (SELECT DISTINCT o_orderkey::VARCHAR AS p, o_custkey::VARCHAR AS a, c_mktsegment AS t, n_name AS c FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey),
    uses AS (SELECT l_orderkey::VARCHAR AS p, p_type AS m, p_brand AS s, l_discount, l_tax FROM lineitem JOIN part ON p_partkey = l_partkey), meth AS (SELECT DISTINCT p, m FROM uses), sens AS (SELECT DISTINCT p, s FROM uses), topic AS (SELECT DISTINCT p, t FROM papers), country AS (SELECT DISTINCT p, c FROM papers)"""


@query(
    "G1 G9",
    f"""WITH {_EDGES} SELECT 'edge' AS what, 'WRITTEN_BY' AS name, count(*) AS n FROM (SELECT DISTINCT p, a FROM papers) UNION ALL SELECT 'edge', 'HAS_TOPIC', count(*) FROM topic UNION ALL SELECT 'edge', 'FROM_COUNTRY', count(*) FROM country UNION ALL SELECT 'edge', 'USES_METHOD', count(*) FROM meth
        UNION ALL SELECT 'edge', 'USES_SENSOR', count(*) FROM sens UNION ALL SELECT 'node', 'Paper', count(*) FROM (SELECT p FROM papers UNION SELECT p FROM uses) UNION ALL SELECT 'node', 'Author', count(DISTINCT a) FROM papers UNION ALL SELECT 'node', 'Topic', count(DISTINCT t) FROM papers
        UNION ALL SELECT 'node', 'Country', count(DISTINCT c) FROM papers UNION ALL SELECT 'node', 'Method', count(DISTINCT m) FROM meth UNION ALL SELECT 'node', 'Sensor', count(DISTINCT s) FROM sens""",
)
def g_phases(t: Tables) -> DataFrame:
    """How many nodes of each label and edges of each kind the phases make."""
    nodes, edges = graph(t)
    return nodes.groupBy(F.col("label").alias("name")).agg(F.count("*").alias("n")).select(F.lit("node").alias("what"), "name", "n").union(edges.groupBy(F.col("kind").alias("name")).agg(F.count("*").alias("n")).select(F.lit("edge").alias("what"), "name", "n"))


@query("G8 J22", f"WITH {_EDGES} SELECT m AS method, count(DISTINCT p) AS n FROM sens JOIN topic USING (p) JOIN meth USING (p) WHERE contains(t, '{TOPIC}') AND s IN ('Brand#11', 'Brand#12', 'Brand#13') GROUP BY 1 ORDER BY n DESC, m LIMIT 15")
def g_methods_of_sensor_and_topic(t: Tables) -> DataFrame:
    """Methods of the papers of one topic that use a sensor of one family."""
    _, e = graph(t)
    hits = G.step(e, "USES_SENSOR", "p", "s").filter(F.col("s").isin(*SENSORS)).join(G.step(e, "HAS_TOPIC", "p", "t").filter(F.col("t").contains(TOPIC)), "p").join(G.step(e, "USES_METHOD", "p", "method"), "p")
    return hits.groupBy("method").agg(F.count_distinct("p").alias("n")).orderBy(F.desc("n"), "method").limit(15)


@query(
    "G8 J12 A12",
    f"""WITH {_EDGES}, m AS (SELECT p, string_agg(m, ',' ORDER BY m) AS methods FROM meth GROUP BY 1) SELECT o_orderkey, o_totalprice, c AS country, coalesce(methods, '') AS methods FROM orders JOIN topic ON topic.p = o_orderkey::VARCHAR LEFT JOIN m ON m.p = topic.p LEFT JOIN country ON country.p = topic.p WHERE contains(t, '{TOPIC}') ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""",
)
def g_influential_of_topic(t: Tables) -> DataFrame:
    """The dearest papers of a topic with their country and all their methods, if any."""
    _, e = graph(t)
    rows = G.step(e, "HAS_TOPIC", "p", "t").filter(F.col("t").contains(TOPIC)).join(t.orders.select(F.col("o_orderkey").cast("string").alias("p"), "o_orderkey", "o_totalprice"), "p")
    top = rows.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)
    top = top.join(G.collected(e, "USES_METHOD", "p", "methods"), "p", "left").join(G.step(e, "FROM_COUNTRY", "p", "country"), "p", "left")
    return top.select("o_orderkey", "o_totalprice", "country", F.coalesce("methods", F.lit("")).alias("methods"))


@query("G8", f"WITH {_EDGES} SELECT o_orderkey, o_totalprice, m AS method, s AS sensor FROM orders JOIN meth ON meth.p = o_orderkey::VARCHAR JOIN sens ON sens.p = meth.p WHERE m IN ('LARGE', 'PROMO') AND s IN ('Brand#11', 'Brand#12', 'Brand#13') ORDER BY o_totalprice DESC, o_orderkey, m, s LIMIT 25")
def g_method_with_sensor(t: Tables) -> DataFrame:
    """Papers that use a method of one family and a sensor of another."""
    _, e = graph(t)
    rows = G.step(e, "USES_METHOD", "p", "method").filter(F.col("method").isin(*METHODS)).join(G.step(e, "USES_SENSOR", "p", "sensor").filter(F.col("sensor").isin(*SENSORS)), "p")
    rows = rows.join(t.orders.select(F.col("o_orderkey").cast("string").alias("p"), "o_orderkey", "o_totalprice"), "p").drop("p")
    return rows.orderBy(F.desc("o_totalprice"), "o_orderkey", "method", "sensor").limit(25).select("o_orderkey", "o_totalprice", "method", "sensor")


@query(
    "G8 G10",
    f"""WITH {_EDGES}, m AS (SELECT p, string_agg(m, ',' ORDER BY m) AS methods FROM meth GROUP BY 1), s AS (SELECT p, string_agg(s, ',' ORDER BY s) AS sensors FROM sens GROUP BY 1) SELECT country.p AS paper, coalesce(methods, '') AS methods, coalesce(sensors, '') AS sensors FROM country JOIN topic ON topic.p = country.p LEFT JOIN m ON m.p = country.p LEFT JOIN s ON s.p = country.p WHERE c = 'NATION_3' AND contains(t, '{TOPIC}')""",
)
def g_studies_of_country(t: Tables) -> DataFrame:
    """All papers of a country on a topic with methods and sensors."""
    _, e = graph(t)
    rows = G.step(e, "FROM_COUNTRY", "paper", "c").filter("c = 'NATION_3'").join(G.step(e, "HAS_TOPIC", "paper", "t").filter(F.col("t").contains(TOPIC)), "paper")
    rows = rows.join(G.collected(e, "USES_METHOD", "paper", "methods"), "paper", "left").join(G.collected(e, "USES_SENSOR", "paper", "sensors"), "paper", "left")
    return rows.select("paper", F.coalesce("methods", F.lit("")).alias("methods"), F.coalesce("sensors", F.lit("")).alias("sensors"))


@query("G8 G7 J7", f"WITH {_EDGES} SELECT m AS method, s AS sensor, count(*) AS n FROM meth JOIN sens USING (p) GROUP BY 1, 2 HAVING count(*) >= 3")
def g_sensor_method_pairs(t: Tables) -> DataFrame:
    """Pairs of method and sensor by how many papers use both, from three on."""
    _, e = graph(t)
    return G.step(e, "USES_METHOD", "p", "method").join(G.step(e, "USES_SENSOR", "p", "sensor"), "p").groupBy("method", "sensor").agg(F.count("*").alias("n")).filter("n >= 3")


@query("G10 A1", f"WITH {_EDGES} SELECT t AS topic, c AS country, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY t), 3)::DOUBLE AS pct FROM topic JOIN country USING (p) GROUP BY 1, 2")
def g_topic_countries(t: Tables) -> DataFrame:
    """Countries of each topic's papers with their shares."""
    _, e = graph(t)
    n = G.step(e, "HAS_TOPIC", "p", "topic").join(G.step(e, "FROM_COUNTRY", "p", "country"), "p").groupBy("topic", "country").agg(F.count("*").alias("n"))
    total = n.groupBy("topic").agg(F.sum("n").alias("total"))
    return n.join(total, "topic").select("topic", "country", "n", F.round(100.0 * F.col("n") / F.col("total"), 3).alias("pct"))
