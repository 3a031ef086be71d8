"""Queries on windows, sorting and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .registry import Tables, query


@query(
    "W1",
    """SELECT o_custkey, o_orderkey, rn FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn <= 3""",
)
def w_top3(t: Tables) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return t.orders.select("o_custkey", "o_orderkey", F.row_number().over(w).cast("long").alias("rn")).filter("rn <= 3")


@query(
    "W2 W4",
    """WITH c AS (SELECT l_suppkey, p_brand, count(DISTINCT l_orderkey) AS n FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, p_brand) AS rn, sum(n) OVER (PARTITION BY l_suppkey)::BIGINT AS total FROM c)
       SELECT l_suppkey, p_brand AS top_brand, n, total FROM r WHERE rn = 1""",
)
def w_rank_over_agg(t: Tables) -> DataFrame:
    rows = t.lineitem.join(t.part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    c = rows.groupBy("l_suppkey", "p_brand").agg(F.countDistinct("l_orderkey").alias("n"))
    # an aggregate instead of a window: counts are already few, and no group is sorted
    top = c.groupBy("l_suppkey").agg(F.min(F.struct((-F.col("n")).alias("m"), "p_brand")).alias("b"), F.sum("n").alias("total"))
    return top.select("l_suppkey", F.col("b.p_brand").alias("top_brand"), (-F.col("b.m")).alias("n"), "total")


@query(
    "W3",
    """SELECT o_orderpriority, count(*) AS n, round(count(*)::DOUBLE / sum(count(*)) OVER (), 6) AS share FROM orders GROUP BY 1""",
)
def w_share(t: Tables) -> DataFrame:
    c = t.orders.groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    return c.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 6))


@query("W4", "SELECT l_orderkey, first(l_partkey ORDER BY l_extendedprice DESC, l_linenumber, l_partkey) AS dearest FROM lineitem GROUP BY 1")
def w_argmax(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_orderkey").agg(F.min_by("l_partkey", F.struct(-F.col("l_extendedprice"), "l_linenumber", "l_partkey")).alias("dearest"))


@query(
    "W5",
    """SELECT conv_id, turn, lead(turn) OVER w AS next_turn, lead(role) OVER w AS next_role FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)""",
)
def w_follow(t: Tables) -> DataFrame:
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return t.conversations.select("conv_id", "turn", F.lead("turn").over(w).alias("next_turn"), F.lead("role").over(w).alias("next_role"))


@query(
    "W6",
    """SELECT l_orderkey, l_linenumber, format('{}_tbl_{:03d}', l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey)) AS table_id FROM lineitem""",
)
def w_ordinals(t: Tables) -> DataFrame:
    n = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey"))
    return t.lineitem.select("l_orderkey", "l_linenumber", F.format_string("%d_tbl_%03d", "l_orderkey", n).alias("table_id"))


@query(
    "W7",
    """WITH c AS (SELECT o_orderpriority, year(o_orderdate)::INT AS yr, count(*) AS n FROM orders GROUP BY 1, 2) SELECT *, round(100.0::DOUBLE * (n - lag(n) OVER w) / lag(n) OVER w, 4) AS growth FROM c WINDOW w AS (PARTITION BY o_orderpriority ORDER BY yr)""",
)
def w_yoy(t: Tables) -> DataFrame:
    c = t.orders.groupBy("o_orderpriority", F.year("o_orderdate").alias("yr")).agg(F.count("*").alias("n"))
    before = F.lag("n").over(Window.partitionBy("o_orderpriority").orderBy("yr"))
    return c.withColumn("growth", F.round(F.lit(100.0) * (F.col("n") - before) / before, 4))


@query(
    "T3",
    """SELECT o_orderkey, o_orderstatus FROM orders ORDER BY CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'O' THEN 1 ELSE 2 END, o_totalprice DESC, o_orderkey LIMIT 100""",
)
def t_priority(t: Tables) -> DataFrame:
    rank = F.when(F.col("o_orderstatus") == "P", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    return t.orders.orderBy(rank, F.desc("o_totalprice"), "o_orderkey").limit(100).select("o_orderkey", "o_orderstatus")


@query(
    "T4 T2 T8",
    """SELECT c_custkey FROM customer ORDER BY (c_acctbal > 0) DESC, length(c_name) DESC, c_acctbal DESC NULLS LAST, c_custkey LIMIT 60""",
)
def t_computed_keys(t: Tables) -> DataFrame:
    return t.customer.orderBy(F.desc(F.col("c_acctbal") > 0), F.desc(F.length("c_name")), F.desc_nulls_last("c_acctbal"), "c_custkey").limit(60).select("c_custkey")


@query("T5", "SELECT DISTINCT p_brand, p_size FROM part ORDER BY p_size DESC, p_brand LIMIT 300")
def t_distinct_sorted(t: Tables) -> DataFrame:
    return t.part.select("p_brand", "p_size").distinct().orderBy(F.desc("p_size"), "p_brand").limit(300)


@query(
    "T7 U2",
    """WITH a AS (SELECT p_partkey, 1 AS src, row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) AS rn FROM part), b AS (SELECT p_partkey, 2 AS src, row_number() OVER (ORDER BY p_size DESC, p_partkey) AS rn FROM part), c AS (SELECT p_partkey, 3 AS src, row_number() OVER (ORDER BY p_name, p_partkey) AS rn FROM part),
       u AS (SELECT * FROM a WHERE rn <= 4 UNION ALL SELECT * FROM b WHERE rn <= 4 UNION ALL SELECT * FROM c WHERE rn <= 4), d AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY src, rn) AS k FROM u) SELECT p_partkey, src::INT AS src FROM d WHERE k = 1 ORDER BY d.src, rn LIMIT 12""",
)
def t_quota_merge(t: Tables) -> DataFrame:
    def best(src: int, *order) -> DataFrame:
        top = t.part.orderBy(*order, "p_partkey").limit(4)
        return top.select("p_partkey", F.lit(src).alias("src"), F.row_number().over(Window.orderBy(*order, "p_partkey")).alias("rn"))

    u = best(1, F.desc("p_retailprice")).union(best(2, F.desc("p_size"))).union(best(3, F.asc("p_name")))
    first = u.groupBy("p_partkey").agg(F.min(F.struct("src", "rn")).alias("b"))
    return first.orderBy("b.src", "b.rn").limit(12).select("p_partkey", F.col("b.src").alias("src"))


@query("U1", "SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
def u_union(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_nationkey").alias("k")).union(t.supplier.select("s_nationkey")).distinct()


@query(
    "U2 S16",
    """WITH u AS (SELECT o_custkey AS k, o_orderkey AS v, 1 AS src FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT c_custkey, -c_custkey, 2 FROM customer) SELECT k, v FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY src, v) AS rn FROM u) WHERE rn = 1""",
)
def u_dedup_first(t: Tables) -> DataFrame:
    u = t.orders.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("v"), F.lit(1).alias("src"))
    u = u.union(t.customer.select("c_custkey", -F.col("c_custkey"), F.lit(2)))
    return u.groupBy("k").agg(F.min(F.struct("src", "v")).alias("b")).select("k", "b.v")


@query(
    "U3 S11",
    """SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, NULL::VARCHAR AS segment FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal, 'supplier' FROM supplier""",
)
def u_coerced_concat(t: Tables) -> DataFrame:
    a = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    b = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"), F.lit("supplier").alias("segment"))
    return a.unionByName(b, allowMissingColumns=True)


@query("U4", "SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O'")
def u_intersect(t: Tables) -> DataFrame:
    of = lambda s: t.orders.filter(F.col("o_orderstatus") == s).select(F.col("o_custkey").alias("k"))
    return of("F").intersect(of("O"))


@query("U4", "SELECT p_partkey AS k FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R'")
def u_except(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_partkey").alias("k")).exceptAll(t.lineitem.filter("l_returnflag = 'R'").select("l_partkey").distinct())


@query("U5", "SELECT DISTINCT source, lang FROM documents ORDER BY source, lang")
def u_option_list(t: Tables) -> DataFrame:
    return t.documents.select("source", "lang").distinct().orderBy("source", "lang")


@query(
    "U6",
    """WITH w AS (SELECT p_partkey, unnest(string_split(p_name || ' ' || p_type || ' ' || p_name, ' ')) AS w, generate_subscripts(string_split(p_name || ' ' || p_type || ' ' || p_name, ' '), 1) AS i FROM part), f AS (SELECT p_partkey, w, min(i) AS i FROM w GROUP BY 1, 2)
       SELECT p_partkey, string_agg(w, ' ' ORDER BY i) AS words FROM f GROUP BY 1""",
)
def u_ordered_dedup(t: Tables) -> DataFrame:
    words = F.split(F.concat_ws(" ", "p_name", "p_type", "p_name"), " ")
    return t.part.select("p_partkey", F.array_join(F.array_distinct(words), " ").alias("words"))
