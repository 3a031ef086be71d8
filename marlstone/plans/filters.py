"""Queries on predicates and projections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import predicates as P
from .registry import Tables, query


@query(
    "F1 F2 A1",
    """SELECT yr, count(*) AS n_orders FROM (SELECT strftime(o_orderdate, '%Y') AS yr, o_orderstatus, o_totalprice FROM orders)
       WHERE regexp_full_match(yr, '[0-9]{4}') AND try_cast(yr AS INT) BETWEEN 1990 AND 2025 AND o_orderstatus IN ('F', 'O') AND o_totalprice >= 1000
       GROUP BY yr""",
)
def f_guarded_year_count(t: Tables) -> DataFrame:
    rows = t.orders.select(F.date_format("o_orderdate", "yyyy").alias("yr"), "o_orderstatus", "o_totalprice")
    state = {"year_min": 1990, "year_max": 2025, "status": ["F", "O"], "price": 1000.0, "open": None}
    where = P.conjunction(state, {"year": "yr", "status": "o_orderstatus", "price": "o_totalprice"})
    return rows.filter(where).groupBy("yr").agg(F.count("*").alias("n_orders"))


@query(
    "F3 F5 T1 T2",
    """SELECT p_partkey, p_name, p_retailprice FROM part WHERE p_name ILIKE '%re%' AND NOT contains(p_name, 'Z%')
       ORDER BY p_retailprice DESC NULLS LAST, p_partkey LIMIT 50""",
)
def f_name_search_topk(t: Tables) -> DataFrame:
    hit = F.lower("p_name").contains("re") & ~F.col("p_name").contains("Z%")
    return t.part.filter(hit).orderBy(F.desc_nulls_last("p_retailprice"), "p_partkey").limit(50).select("p_partkey", "p_name", "p_retailprice")


@query(
    "F4",
    """SELECT p_partkey, p_type FROM part WHERE (lower(p_type) LIKE '%brass%' OR lower(p_type) LIKE '%steel%' OR lower(p_type) LIKE '%tin%'
       OR lower(p_name) LIKE '%a%') AND NOT (lower(p_type) LIKE '%promo%' OR lower(p_type) LIKE '%small%')""",
)
def f_multi_like_guarded(t: Tables) -> DataFrame:
    guards = ["promo", "small"]
    hit = P.matches_any(F.col("p_type"), ["brass", "steel", "tin"], guards) | (P.matches_any(F.col("p_name"), ["a"]) & ~P.matches_any(F.col("p_type"), guards))
    return t.part.filter(hit).select("p_partkey", "p_type")


@query(
    "F6",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity BETWEEN 10 AND 20 AND l_returnflag IN ('A', 'R') AND l_tax IS NOT NULL""",
)
def f_range_in(t: Tables) -> DataFrame:
    where = F.col("l_quantity").between(10, 20) & F.col("l_returnflag").isin("A", "R") & F.col("l_tax").isNotNull()
    return t.lineitem.filter(where).select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    "F7 T6",
    """SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' ORDER BY c_acctbal DESC, c_custkey LIMIT 500)""",
)
def f_ids_of_prior_query(t: Tables) -> DataFrame:
    ids = t.customer.filter("c_mktsegment = 'BUILDING'").orderBy(F.desc("c_acctbal"), "c_custkey").limit(500)
    return t.orders.join(ids, F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("o_orderkey", "o_totalprice")


@query(
    "F8",
    """SELECT page_id, url IS NOT NULL AS has_url, contains(coalesce(url, ''), '?') AS has_query, coalesce(length(html), 0)::BIGINT AS html_length,
       coalesce(nullif(len(regexp_extract_all(coalesce(html, ''), '<p>')), 0), len(regexp_extract_all(coalesce(html, ''), '<div')))::BIGINT AS n_blocks FROM pages""",
)
def f_derived_columns(t: Tables) -> DataFrame:
    html = F.coalesce("html", F.lit(""))
    blocks = F.size(F.regexp_extract_all(html, F.lit("<p>"), F.lit(0)))
    other = F.size(F.regexp_extract_all(html, F.lit("<div"), F.lit(0)))
    return t.pages.select(
        "page_id", F.col("url").isNotNull().alias("has_url"), F.coalesce("url", F.lit("")).contains("?").alias("has_query"),
        F.coalesce(F.length("html"), F.lit(0)).cast("long").alias("html_length"),
        F.when(blocks != 0, blocks).otherwise(other).cast("long").alias("n_blocks"),
    )


@query(
    "F9 F12 F13",
    """SELECT event_id, CASE WHEN lower(trim(v)) NOT IN ('', 'nan', 'none', 'null', 'unknown') THEN trim(v) END AS label, try_cast(k AS INT) AS k
       FROM (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN ' Unknown ' WHEN event_id % 11 = 0 THEN '  ' ELSE event_type || ' ' END AS v,
             CASE WHEN event_id % 5 = 0 THEN 'n/a' ELSE json_extract_string(props, '$.k') END AS k FROM events)""",
)
def f_safe_values(t: Tables) -> DataFrame:
    raw = F.when(F.col("event_id") % 7 == 0, " Unknown ").when(F.col("event_id") % 11 == 0, "  ").otherwise(F.concat("event_type", F.lit(" ")))
    number = F.when(F.col("event_id") % 5 == 0, "n/a").otherwise(F.get_json_object("props", "$.k"))
    rows = t.events.select("event_id", raw.alias("v"), number.alias("k"))
    return rows.select("event_id", P.blank_to_null(F.col("v")).alias("label"), F.expr("try_cast(k as int)").alias("k"))


@query(
    "F10",
    """SELECT page_id, regexp_replace(url, '^https?://(www\\.)?', '') AS bare FROM pages""",
)
def f_prefix_strip(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.regexp_replace("url", r"^https?://(www\.)?", "").alias("bare"))


@query(
    "F11",
    """SELECT c_custkey FROM customer WHERE (c_acctbal > 0 AND c_mktsegment = 'BUILDING') OR c_acctbal >= 5000 OR c_nationkey = 3 OR c_custkey % 97 = 0""",
)
def f_keep_rule(t: Tables) -> DataFrame:
    keep = P.any_of([(F.col("c_acctbal") > 0) & (F.col("c_mktsegment") == "BUILDING"), F.col("c_acctbal") >= 5000, F.col("c_nationkey") == 3, F.col("c_custkey") % 97 == 0])
    return t.customer.filter(keep).select("c_custkey")
