"""Queries on numeric functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import numeric as N
from .registry import Tables, query

# events stand in for measured facts: the type is the metric, the value the raw number
_METRIC = {"view": "overall_accuracy", "click": "kappa", "purchase": "rmse", "error": "nse", "signup": "method.scs_cn"}
_METRIC_SQL = "CASE event_type WHEN 'view' THEN 'overall_accuracy' WHEN 'click' THEN 'kappa' WHEN 'purchase' THEN 'rmse' WHEN 'error' THEN 'nse' ELSE 'method.scs_cn' END"


def _facts(t: Tables) -> DataFrame:
    metric = F.when(F.lit(False), "")
    for kind, name in _METRIC.items():
        metric = metric.when(F.col("event_type") == kind, name)
    rows = t.events.select("event_id", metric.alias("metric"), (F.round("value", 2) - 20).alias("raw"))
    return rows.join(F.broadcast(N.range_table(rows)), "metric", "left")


@query(
    "M1",
    """SELECT event_id, try_cast(regexp_replace(regexp_replace(trim(raw), '%+$', ''), ',', '.', 'g') AS DOUBLE) AS v FROM (SELECT event_id, CASE event_id % 4 WHEN 0 THEN ' 12,5% ' WHEN 1 THEN 'n/a' WHEN 2 THEN (event_id % 100)::VARCHAR ELSE '-0.5' END AS raw FROM events)""",
)
def m_parse_float(t: Tables) -> DataFrame:
    k = F.col("event_id") % 4
    raw = F.when(k == 0, " 12,5% ").when(k == 1, "n/a").when(k == 2, (F.col("event_id") % 100).cast("string")).otherwise("-0.5")
    return t.events.select("event_id", N.parsed(raw).alias("v"))


_RANGES_SQL = "(VALUES ('overall_accuracy', 0.0, 1.0, true), ('kappa', -1.0, 1.0, true), ('rmse', 0.0, 1e300, false), ('nse', -1e300, 1.0, false)) r(metric, lo, hi, pf)"


@query(
    "M2 M3 M4 M6 D8",
    f"""SELECT event_id, f.metric, CASE WHEN lo IS NULL THEN 'unknown_metric' WHEN raw BETWEEN lo AND hi THEN 'ok' ELSE 'suspect' END AS verdict,
        round(CASE WHEN lo IS NULL OR raw BETWEEN lo AND hi THEN raw WHEN pf AND abs(raw) > 1 AND abs(raw) <= 100 AND raw / 100 BETWEEN lo AND hi THEN raw / 100 END, 4) AS normal
        FROM (SELECT event_id, {_METRIC_SQL} AS metric, round(value, 2) - 20 AS raw FROM events) f LEFT JOIN {_RANGES_SQL} ON r.metric = f.metric""",
)
def m_normalise(t: Tables) -> DataFrame:
    raw = F.col("raw")
    return _facts(t).select("event_id", "metric", N.in_range(raw).alias("verdict"), N.normalised_fact(F.col("metric"), raw).alias("normal"))


@query(
    "M5",
    """SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN 'm³/s' WHEN 1 THEN 'unknown' WHEN 2 THEN 'mm/day' WHEN 3 THEN 'Furlong' WHEN 4 THEN 'unknown' ELSE 'dimensionless' END AS unit, p_size % 6 IN (0) AS comparable FROM part""",
)
def m_units(t: Tables) -> DataFrame:
    k = F.col("p_size") % 6
    raw = F.when(k == 0, " M3 / s").when(k == 1, "  ").when(k == 2, "mm/d").when(k == 3, " Furlong").when(k == 5, "-")
    return t.part.select("p_partkey", N.canonical_unit(raw).alias("unit"), F.coalesce(N.comparable(raw, F.lit("cumecs")), F.lit(False)).alias("comparable"))


@query(
    "M7",
    """SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN (p_size + p_size + 2) / 2.0 WHEN 1 THEN p_size WHEN 2 THEN p_size + 0.5 END::DOUBLE AS mid FROM part""",
)
def m_midpoint(t: Tables) -> DataFrame:
    k, s = F.col("p_size") % 4, F.col("p_size").cast("string")
    raw = F.when(k == 0, F.concat(s, F.lit(" - "), (F.col("p_size") + 2).cast("string"))).when(k == 1, F.concat(F.lit(">"), s)).when(k == 2, F.concat(s, F.lit(".5"))).otherwise("none")
    return t.part.select("p_partkey", N.midpoint(raw).alias("mid"))


@query(
    "M8 M9",
    """SELECT o_custkey, round(least(0.15, 0.15 * ln(1 + count(*)) / ln(501)), 6) AS boost, round(0.6 * avg(o_totalprice) / 500000 + 0.4 * least(1.0, count(*) / 20.0), 6) AS confidence FROM orders GROUP BY 1""",
)
def m_composites(t: Tables) -> DataFrame:
    per = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"), (F.avg("o_totalprice") / 500000).alias("q"))
    per = per.withColumn("e", F.least(F.lit(1.0), F.col("n") / 20))
    return per.select("o_custkey", F.round(N.log_boost(F.col("n")), 6).alias("boost"), F.round(N.weighted({"q": 0.6, "e": 0.4}), 6).alias("confidence"))


@query(
    "M10 G5",
    """SELECT l_orderkey, round(product(1 - l_discount), 6) AS confidence, count(*) AS hops FROM lineitem GROUP BY 1 ORDER BY confidence DESC, l_orderkey LIMIT 20""",
)
def g_path_product(t: Tables) -> DataFrame:
    per = t.lineitem.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(1 - F.col("l_discount"))).alias("c"))
    return per.select("l_orderkey", F.round(N.product("c"), 6).alias("confidence"), F.size("c").cast("long").alias("hops")).orderBy(F.desc("confidence"), "l_orderkey").limit(20)


@query(
    "M13",
    """SELECT round(sum(round(l_quantity / 4, 1)), 4) AS away, round(sum(round_even(l_quantity / 4, 1)), 4) AS even FROM lineitem""",
)
def m_rounding(t: Tables) -> DataFrame:
    q = F.col("l_quantity") / 4
    return t.lineitem.agg(F.round(F.sum(F.round(q, 1)), 4).alias("away"), F.round(F.sum(F.bround(q, 1)), 4).alias("even"))


@query(
    "A27 R7",
    """SELECT event_type, count(*) AS n, round(avg(json_extract(props, '$.k')::DOUBLE), 6) AS mean_k, strftime(min(ts), '%Y%m') AS first_month, min(ts::DATE) AS first_day FROM events GROUP BY 1""",
)
def r_json_stage(t: Tables) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("double")
    return t.events.groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.avg(k), 6).alias("mean_k"), F.date_format(F.min("ts"), "yyyyMM").alias("first_month"), F.min(F.to_date("ts")).alias("first_day"))
