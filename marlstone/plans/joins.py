"""Queries on joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import joining as J
from .registry import Tables, query


@query(
    "J2 A3 T1",
    """SELECT p_type, count(DISTINCT o_orderkey) AS n_orders FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey
       GROUP BY p_type ORDER BY n_orders DESC, p_type LIMIT 25""",
)
def j_bridge_top_topics(t: Tables) -> DataFrame:
    # lineitem names each of its orders, so the order's own row adds nothing but the check that it exists
    rows = t.lineitem.join(t.orders.select("o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey")).join(t.part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    return rows.groupBy("p_type").agg(F.countDistinct("o_orderkey").alias("n_orders")).orderBy(F.desc("n_orders"), "p_type").limit(25)


@query(
    "J3 A4",
    """SELECT strftime(o_orderdate, '%Y') AS yr, count(DISTINCT o_orderkey) AS n_orders, count(DISTINCT CASE WHEN b.l_returnflag = 'R' THEN o_orderkey END) AS n_returned,
       round(avg(o_totalprice), 2) AS avg_price FROM orders JOIN lineitem a ON a.l_orderkey = o_orderkey LEFT JOIN lineitem b ON b.l_orderkey = o_orderkey AND b.l_linenumber <> a.l_linenumber
       WHERE a.l_returnflag = 'A' GROUP BY 1""",
)
def j_fanout_conditional_distinct(t: Tables) -> DataFrame:
    # the average is weighted by the fan-out on purpose
    a = t.lineitem.filter("l_returnflag = 'A'").select(F.col("l_orderkey").alias("ak"), F.col("l_linenumber").alias("al"))
    b = t.lineitem.select(F.col("l_orderkey").alias("bk"), F.col("l_linenumber").alias("bl"), "l_returnflag")
    rows = t.orders.select("o_orderkey", "o_orderdate", "o_totalprice").join(a, F.col("ak") == F.col("o_orderkey"))
    rows = rows.join(b, (F.col("bk") == F.col("o_orderkey")) & (F.col("bl") != F.col("al")), "left")
    return rows.groupBy(F.date_format("o_orderdate", "yyyy").alias("yr")).agg(
        F.countDistinct("o_orderkey").alias("n_orders"), F.countDistinct(F.when(F.col("l_returnflag") == "R", F.col("o_orderkey"))).alias("n_returned"),
        F.round(F.avg("o_totalprice"), 2).alias("avg_price"),
    )


@query(
    "J4 A7",
    """SELECT c_custkey, n_name, count(DISTINCT o_orderkey) AS n_orders, round(coalesce(sum(o_totalprice), 0), 2) AS total FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey
       LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, n_name""",
)
def j_author_influence(t: Tables) -> DataFrame:
    per = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("s"))
    rows = t.customer.join(F.broadcast(t.nation), F.col("n_nationkey") == F.col("c_nationkey"), "left").join(per, F.col("o_custkey") == F.col("c_custkey"), "left")
    return rows.select("c_custkey", "n_name", F.coalesce("n", F.lit(0)).alias("n_orders"), F.round(F.coalesce("s", F.lit(0.0)), 2).alias("total"))


@query(
    "J5",
    """SELECT p2.p_type AS other_type, count(DISTINCT a.l_orderkey) AS n_orders FROM lineitem a JOIN part p1 ON p1.p_partkey = a.l_partkey JOIN lineitem b ON a.l_orderkey = b.l_orderkey
       JOIN part p2 ON p2.p_partkey = b.l_partkey WHERE p1.p_type = (SELECT min(p_type) FROM part) AND p2.p_type <> p1.p_type GROUP BY 1""",
)
def j_cotopic(t: Tables) -> DataFrame:
    # only orders with the type asked for meet the other lines
    typed = t.lineitem.join(t.part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "p_type")
    first = t.part.agg(F.min("p_type").alias("wanted"))
    mine = typed.join(F.broadcast(first), F.col("p_type") == F.col("wanted"), "left_semi").select(F.col("l_orderkey").alias("k")).distinct()
    others = typed.join(F.broadcast(first), F.col("p_type") == F.col("wanted"), "left_anti").join(mine, F.col("l_orderkey") == F.col("k"), "left_semi")
    return others.groupBy(F.col("p_type").alias("other_type")).agg(F.countDistinct("l_orderkey").alias("n_orders"))


@query(
    "J6 G7",
    """WITH once AS (SELECT DISTINCT l_orderkey, p_brand FROM lineitem JOIN part ON p_partkey = l_partkey)
       SELECT a.p_brand AS a, b.p_brand AS b, count(*) AS n FROM once a JOIN once b ON a.l_orderkey = b.l_orderkey AND a.p_brand < b.p_brand GROUP BY 1, 2 HAVING count(*) >= 3""",
)
def g_cooccur_part_pairs(t: Tables) -> DataFrame:
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return J.pairs_within(rows, "l_orderkey", "p_brand", 3)


@query(
    "J7",
    """WITH m AS (SELECT DISTINCT l_orderkey, p_brand FROM lineitem JOIN part ON p_partkey = l_partkey), s AS (SELECT DISTINCT l_orderkey, s_nationkey FROM lineitem JOIN supplier ON s_suppkey = l_suppkey)
       SELECT p_brand, s_nationkey, count(*) AS n FROM m JOIN s USING (l_orderkey) GROUP BY 1, 2""",
)
def g_cooccur_part_supplier(t: Tables) -> DataFrame:
    m = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "p_brand").distinct()
    s = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select("l_orderkey", "s_nationkey").distinct()
    return m.join(s, "l_orderkey").groupBy("p_brand", "s_nationkey").agg(F.count("*").alias("n"))


@query(
    "J8 F14",
    """WITH e AS (SELECT * FROM (VALUES (1, 'flood', 3, 1995), (2, 'drought', 3, NULL), (3, 'storm', 7, 1997), (4, 'fire', 12, 1992)) v(event_no, kind, nationkey, yr)),
       o AS (SELECT o_orderkey, c_nationkey, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE year(o_orderdate) END AS yr FROM orders JOIN customer ON c_custkey = o_custkey)
       SELECT event_no, o_orderkey FROM o JOIN e ON o.c_nationkey = e.nationkey WHERE o.yr IS NULL OR e.yr IS NULL OR abs(o.yr - e.yr) <= 3""",
)
def j_theta_year_window(t: Tables) -> DataFrame:
    events = t.spark.createDataFrame([(1, "flood", 3, 1995), (2, "drought", 3, None), (3, "storm", 7, 1997), (4, "fire", 12, 1992)], "event_no int, kind string, nationkey int, event_year int")
    rows = t.orders.join(t.customer.select("c_custkey", "c_nationkey"), F.col("c_custkey") == F.col("o_custkey"))
    rows = rows.select("o_orderkey", "c_nationkey", F.when(F.col("o_orderkey") % 10 != 0, F.year("o_orderdate")).alias("yr"))
    near = F.col("yr").isNull() | F.col("event_year").isNull() | (F.abs(F.col("yr") - F.col("event_year")) <= 3)
    return rows.join(F.broadcast(events), (F.col("c_nationkey") == F.col("nationkey")) & near).select("event_no", "o_orderkey")


@query("J9", "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 100000)")
def j_semi(t: Tables) -> DataFrame:
    return t.customer.join(t.orders.filter("o_totalprice > 100000"), F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("c_custkey")


@query("J10", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def j_anti(t: Tables) -> DataFrame:
    return t.customer.join(t.orders, F.col("o_custkey") == F.col("c_custkey"), "left_anti").select("c_custkey")


@query(
    "J11",
    """SELECT DISTINCT c.c_nationkey AS src, s.s_nationkey AS dst FROM orders JOIN customer c ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier s ON s_suppkey = l_suppkey WHERE c.c_nationkey <> s.s_nationkey""",
)
def j_key_translation(t: Tables) -> DataFrame:
    edges = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select("l_orderkey", F.col("s_nationkey").alias("dst")).distinct()
    home = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", F.col("c_nationkey").alias("src"))
    return edges.join(home, F.col("l_orderkey") == F.col("o_orderkey")).filter("src <> dst").select("src", "dst").distinct()


@query(
    "J12 A12",
    """SELECT c_custkey, coalesce(string_agg(DISTINCT o_orderpriority, '|' ORDER BY o_orderpriority), '') AS priorities FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey""",
)
def j_optional_collect(t: Tables) -> DataFrame:
    sets = t.orders.groupBy("o_custkey").agg(F.array_join(F.array_sort(F.collect_set("o_orderpriority")), "|").alias("p"))
    return t.customer.join(sets, F.col("o_custkey") == F.col("c_custkey"), "left").select("c_custkey", F.coalesce("p", F.lit("")).alias("priorities"))


@query(
    "J13",
    """WITH v AS (SELECT user_id, ts, max(event_id) AS event_id FROM events WHERE event_type = 'view' GROUP BY user_id, ts)
       SELECT e.event_id, v.event_id AS asof_view FROM (SELECT * FROM events WHERE event_type = 'error') e ASOF LEFT JOIN v ON e.user_id = v.user_id AND e.ts >= v.ts""",
)
def j_asof_event(t: Tables) -> DataFrame:
    errors = t.events.filter("event_type = 'error'").select("event_id", "user_id", "ts")
    views = t.events.filter("event_type = 'view'").select("user_id", "ts", F.col("event_id").alias("view"))
    return J.asof(errors, views, "user_id", "ts", "view").select("event_id", "asof_view")


_POINTS = "SELECT l_orderkey * 10 + l_linenumber AS id, l_suppkey AS page, l_quantity * 12 AS x, l_discount * 4000 AS y, l_returnflag FROM lineitem"


def _points(t: Tables) -> DataFrame:
    return t.lineitem.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("l_suppkey").alias("page"), (F.col("l_quantity") * 12).alias("x"), (F.col("l_discount") * 4000).alias("y"), "l_returnflag"
    )


@query(
    "J14 M12",
    f"""WITH p AS ({_POINTS}), n AS (SELECT a.page, a.id AS left_id, b.id AS right_id, sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) AS d,
        row_number() OVER (PARTITION BY a.page, a.id ORDER BY round(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2), 6), b.id) AS rn
        FROM p a JOIN p b ON a.page = b.page AND a.l_returnflag = 'A' AND b.l_returnflag = 'R' AND abs(a.x - b.x) <= 40 AND abs(a.y - b.y) <= 40
        WHERE round(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2), 6) <= 40) SELECT page, left_id, right_id, round(d, 6) AS distance FROM n WHERE rn = 1""",
)
def j_nearest(t: Tables) -> DataFrame:
    p = _points(t)
    near = J.nearest(p.filter("l_returnflag = 'A'"), p.filter("l_returnflag = 'R'"), "page", 40.0, "id", "id")
    return near.select("page", "left_id", "right_id", F.round("distance", 6).alias("distance"))


_BOXES = "SELECT p_partkey AS id, p_size AS page, (p_partkey % 40) * 1.0 AS x0, (p_partkey % 23) * 1.0 AS y0, (p_partkey % 40) + 10.0 AS x1, (p_partkey % 23) + 8.0 AS y1 FROM part"


@query(
    "J15 M12",
    f"""WITH p AS (SELECT id, page, x0::DOUBLE AS x0, y0::DOUBLE AS y0, x1::DOUBLE AS x1, y1::DOUBLE AS y1 FROM ({_BOXES})), o AS (SELECT a.id AS a, b.id AS b,
        greatest(0, least(a.x1, b.x1) - greatest(a.x0, b.x0)) * greatest(0, least(a.y1, b.y1) - greatest(a.y0, b.y0)) AS both_area,
        (a.x1 - a.x0) * (a.y1 - a.y0) + (b.x1 - b.x0) * (b.y1 - b.y0) AS areas FROM p a JOIN p b ON a.page = b.page AND a.id < b.id)
        SELECT a, b, round(both_area / (areas - both_area), 6) AS iou FROM o WHERE both_area / (areas - both_area) > 0.5""",
)
def j_overlap_pairs(t: Tables) -> DataFrame:
    i = F.col("p_partkey")
    boxes = t.part.select(i.alias("id"), F.col("p_size").alias("page"), (i % 40).cast("double").alias("x0"), (i % 23).cast("double").alias("y0"), (i % 40 + 10).cast("double").alias("x1"), (i % 23 + 8).cast("double").alias("y1"))
    return J.overlapping(boxes, "page", 0.5).select("a", "b", F.round("iou", 6).alias("iou"))


@query(
    "J16",
    f"""WITH p AS ({_POINTS}), s AS (SELECT a.id AS caption, b.id AS object, abs(a.y - b.y) + 0.5 * abs(a.x - b.x) AS cost, CASE WHEN a.id % 4 = 0 THEN 45.0 ELSE 30.0 END AS most
        FROM p a JOIN p b ON a.page = b.page AND a.l_returnflag = 'A' AND b.l_returnflag = 'N')
        SELECT caption, first(object ORDER BY round(cost, 6), object) AS object, round(min(cost), 6) AS cost FROM s WHERE round(cost, 6) <= most GROUP BY caption""",
)
def j_caption_attach(t: Tables) -> DataFrame:
    p = _points(t)
    most = F.when(F.col("id") % 4 == 0, 45.0).otherwise(30.0)
    # vertical gap at most 45, so slices of that height that touch
    slice_of = F.floor(F.col("y") / 45)
    a = p.filter("l_returnflag = 'A'").select("page", F.col("id").alias("caption"), F.col("x").alias("ax"), F.col("y").alias("ay"), most.alias("most"), F.explode(F.array(slice_of - 1, slice_of, slice_of + 1)).alias("s"))
    b = p.filter("l_returnflag = 'N'").select("page", F.col("id").alias("object"), F.col("x").alias("bx"), F.col("y").alias("by"), slice_of.alias("s"))
    cost = F.round(F.abs(F.col("ay") - F.col("by")) + 0.5 * F.abs(F.col("ax") - F.col("bx")), 6)
    met = a.join(b, ["page", "s"]).withColumn("cost", cost).filter("cost <= most")
    return met.groupBy("caption").agg(F.min(F.struct("cost", "object")).alias("m")).select("caption", "m.object", "m.cost")


@query("J17", "SELECT s_suppkey, n_name, r_name FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey LEFT JOIN region ON r_regionkey = n_regionkey")
def j_lookup(t: Tables) -> DataFrame:
    names = t.nation.join(F.broadcast(t.region), F.col("r_regionkey") == F.col("n_regionkey"), "left").select("n_nationkey", "n_name", "r_name")
    return t.supplier.join(F.broadcast(names), F.col("n_nationkey") == F.col("s_nationkey"), "left").select("s_suppkey", "n_name", "r_name")


@query(
    "J18 W1 X17",
    """WITH top3 AS (SELECT l_orderkey, string_agg(l_partkey::VARCHAR, ',' ORDER BY rn) AS parts FROM (SELECT l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber) AS rn FROM lineitem) WHERE rn <= 3 GROUP BY l_orderkey)
       SELECT o_orderkey, c_name, coalesce(parts, '') AS parts FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN top3 ON l_orderkey = o_orderkey""",
)
def j_enrich_top3(t: Tables) -> DataFrame:
    w = Window.partitionBy("l_orderkey").orderBy(F.desc("l_extendedprice"), "l_linenumber")
    top = t.lineitem.withColumn("rn", F.row_number().over(w)).filter("rn <= 3").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("rn", "l_partkey"))).alias("p"))
    top = top.select("l_orderkey", F.array_join(F.transform("p.l_partkey", lambda x: x.cast("string")), ",").alias("parts"))
    rows = t.orders.join(t.customer.select("c_custkey", "c_name"), F.col("c_custkey") == F.col("o_custkey"), "left").join(top, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return rows.select("o_orderkey", "c_name", F.coalesce("parts", F.lit("")).alias("parts"))


@query("J19", "SELECT d.doc_id, quality, toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id")
def j_prediction_goldset(t: Tables) -> DataFrame:
    return t.documents.select("doc_id").join(t.labels, "doc_id", "left").select("doc_id", "quality", "toxic")


@query(
    "J21",
    """SELECT a.conv_id, a.turn AS asked, b.turn AS answered FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id WHERE a.role = 'user' AND b.role = 'assistant'""",
)
def j_role_pairs(t: Tables) -> DataFrame:
    a = t.conversations.filter("role = 'user'").select("conv_id", F.col("turn").alias("asked"))
    b = t.conversations.filter("role = 'assistant'").select("conv_id", F.col("turn").alias("answered"))
    return a.join(b, "conv_id")


@query(
    "J22 D4",
    """SELECT r_name, count(DISTINCT o_custkey) AS n_customers, count(DISTINCT o_orderkey) AS n_orders, round(avg(l_discount), 6) AS avg_value FROM region JOIN nation ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey
       JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey WHERE l_returnflag = 'R' AND o_orderstatus = 'F' GROUP BY r_name""",
)
def j_multi_hop(t: Tables) -> DataFrame:
    where = t.nation.join(F.broadcast(t.region), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    people = t.customer.join(F.broadcast(where), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "r_name")
    rows = t.orders.filter("o_orderstatus = 'F'").join(people, F.col("o_custkey") == F.col("c_custkey"))
    rows = rows.join(t.lineitem.filter("l_returnflag = 'R'").select("l_orderkey", "l_discount"), F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.groupBy("r_name").agg(F.countDistinct("o_custkey").alias("n_customers"), F.countDistinct("o_orderkey").alias("n_orders"), F.round(F.avg("l_discount"), 6).alias("avg_value"))
