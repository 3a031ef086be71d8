"""Queries on aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import predicates as P
from ..operators.quantiles import exact_quantiles
from .registry import Tables, query


@query(
    "A7 J1 F1 F2 F6 T1",
    """SELECT l_returnflag AS metric, count(*) AS n, round(avg(l_discount), 3) AS mean, round(stddev(l_discount), 3) AS std, round(min(l_discount), 3) AS low, round(max(l_discount), 3) AS high,
       round(100.0::DOUBLE * count(*) FILTER (WHERE l_discount >= 0.05) / count(*), 1) AS pct_over FROM lineitem JOIN orders ON o_orderkey = l_orderkey
       WHERE regexp_full_match(strftime(o_orderdate, '%Y'), '[0-9]{4}') AND year(o_orderdate) BETWEEN 1990 AND 2025 AND l_discount IS NOT NULL GROUP BY 1 HAVING count(*) >= 3 ORDER BY n DESC, metric""",
)
def m_metric_distribution(t: Tables) -> DataFrame:
    years = P.conjunction({"year_min": 1990, "year_max": 2025}, {"year": "yr"})
    orders = t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy").alias("yr")).filter(years)
    rows = t.lineitem.filter("l_discount is not null").join(orders, F.col("o_orderkey") == F.col("l_orderkey"))
    v = F.col("l_discount")
    return rows.groupBy(F.col("l_returnflag").alias("metric")).agg(
        F.count("*").alias("n"), F.round(F.avg(v), 3).alias("mean"), F.round(F.stddev_samp(v), 3).alias("std"), F.round(F.min(v), 3).alias("low"), F.round(F.max(v), 3).alias("high"),
        F.round(F.lit(100.0) * F.count_if(v >= 0.05) / F.count("*"), 1).alias("pct_over"),
    ).filter("n >= 3").orderBy(F.desc("n"), "metric")


@query("A1", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, o_orderpriority LIMIT 15")
def a_count_by_dimension(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_orderpriority").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "o_orderpriority").limit(15)


@query("A2", "SELECT year(o_orderdate)::INT AS yr, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2")
def a_heatmap(t: Tables) -> DataFrame:
    return t.orders.groupBy(F.year("o_orderdate").alias("yr"), "o_orderstatus").agg(F.count("*").alias("n"))


@query(
    "A5 A6 D2",
    """SELECT count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_done, count(*) FILTER (WHERE o_orderstatus = 'O') AS n_open, count(DISTINCT o_custkey) AS n_customers,
       round(100.0::DOUBLE * count(*) FILTER (WHERE o_orderstatus = 'F') / nullif(count(*), 0), 1) AS pct_done, round(100.0::DOUBLE * count(*) FILTER (WHERE o_totalprice > 200000) / nullif(count(*), 0), 1) AS pct_large FROM orders""",
)
def a_kpis_in_one_scan(t: Tables) -> DataFrame:
    n = F.nullif(F.count("*"), F.lit(0))
    return t.orders.agg(
        F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("n_done"), F.count_if(F.col("o_orderstatus") == "O").alias("n_open"), F.countDistinct("o_custkey").alias("n_customers"),
        F.round(F.lit(100.0) * F.count_if(F.col("o_orderstatus") == "F") / n, 1).alias("pct_done"), F.round(F.lit(100.0) * F.count_if(F.col("o_totalprice") > 200000) / n, 1).alias("pct_large"),
    )


@query("A3", "SELECT l_shipdate::DATE AS day, count(DISTINCT l_suppkey) AS n_suppliers, count(DISTINCT l_partkey) AS n_parts FROM lineitem GROUP BY 1")
def a_count_distinct(t: Tables) -> DataFrame:
    return t.lineitem.groupBy(F.to_date("l_shipdate").alias("day")).agg(F.countDistinct("l_suppkey").alias("n_suppliers"), F.countDistinct("l_partkey").alias("n_parts"))


@query("A8", "SELECT o_custkey, count(*) AS n, round(stddev_samp(o_totalprice), 4) AS std FROM orders GROUP BY 1")
def a_sample_stddev(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"), F.round(F.stddev_samp("o_totalprice"), 4).alias("std"))


@query(
    "A9 A10",
    """SELECT event_type, count(*) AS n, round(avg(value), 6) AS mean, round(stddev(value), 6) AS std, round(median(value), 6) AS mid, round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.75), 6) AS p75,
       round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.99), 6) AS p99, min(value) AS low, max(value) AS high FROM events GROUP BY 1""",
)
def a_percentiles(t: Tables) -> DataFrame:
    base = t.events.groupBy("event_type").agg(
        F.count("*").alias("n"), F.round(F.avg("value"), 6).alias("mean"), F.round(F.stddev("value"), 6).alias("std"), F.min("value").alias("low"), F.max("value").alias("high")
    )
    shares = {"mid": 0.5, "p25": 0.25, "p75": 0.75, "p95": 0.95, "p99": 0.99}
    q = exact_quantiles(t.events, "event_type", "value", shares)
    return base.join(q.select("event_type", *[F.round(c, 6).alias(c) for c in shares]), "event_type", "left")


_DOMAIN_SQL = "CASE WHEN p_type ILIKE '%promo%' THEN 'offer' WHEN p_type ILIKE '%large%' OR p_type ILIKE '%medium%' THEN 'big' WHEN p_type ILIKE '%small%' THEN 'little' ELSE 'other' END"


@query(
    "A11 C1",
    f"""WITH per AS (SELECT l_orderkey, {_DOMAIN_SQL} AS domain, avg(l_discount) AS v FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2)
        SELECT domain, count(*) AS n_orders, round(avg(v), 6) AS mean, round(stddev(v), 6) AS std, round(100.0::DOUBLE * count(*) FILTER (WHERE v >= 0.0501) / count(*), 1) AS pct FROM per GROUP BY 1""",
)
def a_two_level_domain(t: Tables) -> DataFrame:
    kind = F.col("p_type")
    domain = F.when(kind.ilike("%promo%"), "offer").when(kind.ilike("%large%") | kind.ilike("%medium%"), "big").when(kind.ilike("%small%"), "little").otherwise("other")
    rows = t.lineitem.join(t.part.select("p_partkey", domain.alias("domain")), F.col("l_partkey") == F.col("p_partkey"))
    per = rows.groupBy("l_orderkey", "domain").agg(F.avg("l_discount").alias("v"))
    return per.groupBy("domain").agg(
        F.count("*").alias("n_orders"), F.round(F.avg("v"), 6).alias("mean"), F.round(F.stddev("v"), 6).alias("std"), F.round(F.lit(100.0) * F.count_if(F.col("v") >= 0.0501) / F.count("*"), 1).alias("pct")
    )


@query(
    "A13",
    """SELECT l_partkey, count(DISTINCT l_orderkey) AS n_orders, count(DISTINCT l_suppkey) AS n_suppliers, max(l_discount) AS top, round(avg(l_discount), 6) AS mean, first(l_suppkey ORDER BY l_orderkey, l_linenumber, l_suppkey) AS first_supplier FROM lineitem GROUP BY 1""",
)
def a_first_seen(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_partkey").agg(
        F.countDistinct("l_orderkey").alias("n_orders"), F.countDistinct("l_suppkey").alias("n_suppliers"), F.max("l_discount").alias("top"), F.round(F.avg("l_discount"), 6).alias("mean"),
        F.min_by("l_suppkey", F.struct("l_orderkey", "l_linenumber", "l_suppkey")).alias("first_supplier"),
    )


@query(
    "A14 X5",
    """SELECT word, count(*) AS n FROM (SELECT lower(trim(unnest(string_split(p_name, ' ')))) AS word FROM part) WHERE word NOT IN ('', 'nan', 'none', 'null', 'unknown') GROUP BY 1""",
)
def a_explode_values(t: Tables) -> DataFrame:
    words = t.part.select(F.explode(F.split("p_name", " ")).alias("w")).select(P.blank_to_null(F.col("w")).alias("w"))
    return words.filter("w is not null").groupBy(F.lower("w").alias("word")).agg(F.count("*").alias("n"))


@query(
    "A15",
    """SELECT grp, count(*) AS n FROM (SELECT unnest(list_filter([CASE WHEN l_quantity > 30 THEN 'bulk' END, CASE WHEN l_discount >= 0.08 THEN 'discounted' END, CASE WHEN l_returnflag = 'R' THEN 'returned' END, CASE WHEN l_tax = 0 THEN 'untaxed' END], lambda x: x IS NOT NULL)) AS grp FROM lineitem) GROUP BY 1""",
)
def a_multi_label(t: Tables) -> DataFrame:
    groups = F.array(
        F.when(F.col("l_quantity") > 30, "bulk"), F.when(F.col("l_discount") >= 0.08, "discounted"), F.when(F.col("l_returnflag") == "R", "returned"), F.when(F.col("l_tax") == 0, "untaxed")
    )
    return t.lineitem.select(F.explode(F.array_compact(groups)).alias("grp")).groupBy("grp").agg(F.count("*").alias("n"))


@query(
    "A16",
    """SELECT c_mktsegment, count(*) AS n, round(avg(c_acctbal), 4) AS mean, min(c_acctbal) AS low, max(c_acctbal) AS high, round(median(c_acctbal), 4) AS mid FROM customer WHERE c_acctbal > 0 GROUP BY 1""",
)
def a_eligible_only(t: Tables) -> DataFrame:
    rows = t.customer.filter("c_acctbal > 0")
    sums = rows.groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.round(F.avg("c_acctbal"), 4).alias("mean"), F.min("c_acctbal").alias("low"), F.max("c_acctbal").alias("high"))
    mid = exact_quantiles(rows, "c_mktsegment", "c_acctbal", {"mid": 0.5})
    return sums.join(mid, "c_mktsegment", "left").withColumn("mid", F.round("mid", 4))


@query(
    "A17",
    """SELECT o_custkey, count(*) AS n, arg_min(o_orderpriority, o_orderkey) AS first_priority, row_number() OVER (ORDER BY count(*) DESC, o_custkey) AS rank FROM orders GROUP BY 1 ORDER BY rank LIMIT 100""",
)
def a_frequency_rank(t: Tables) -> DataFrame:
    top = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"), F.min_by("o_orderpriority", "o_orderkey").alias("first_priority")).orderBy(F.desc("n"), "o_custkey").limit(100)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), "o_custkey")).cast("long"))


@query(
    "A18",
    """SELECT l_returnflag, coalesce(sum(l_quantity) FILTER (WHERE l_linestatus = 'F'), 0) AS F, coalesce(sum(l_quantity) FILTER (WHERE l_linestatus = 'O'), 0) AS O FROM lineitem GROUP BY 1""",
)
def a_pivot(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag").pivot("l_linestatus", ["F", "O"]).agg(F.sum("l_quantity")).na.fill(0.0)


@query(
    "A19",
    """SELECT kind, count(*) AS n, count(*) FILTER (WHERE v >= 0.08) AS high, count(*) FILTER (WHERE v >= 0.04 AND v < 0.08) AS middle, count(*) FILTER (WHERE v < 0.04) AS low FROM
       (SELECT 'discount' AS kind, l_discount AS v FROM lineitem UNION ALL SELECT 'tax', l_tax FROM lineitem UNION ALL SELECT 'share', l_quantity / 500 FROM lineitem) GROUP BY 1""",
)
def a_trust_tiers(t: Tables) -> DataFrame:
    # the three kinds are unpivoted from one scan instead of three
    rows = t.lineitem.select("l_discount", "l_tax", (F.col("l_quantity") / 500).alias("share")).unpivot([], ["l_discount", "l_tax", "share"], "k", "v")
    kind = F.when(F.col("k") == "l_discount", "discount").when(F.col("k") == "l_tax", "tax").otherwise("share")
    v = F.col("v")
    return rows.groupBy(kind.alias("kind")).agg(
        F.count("*").alias("n"), F.count_if(v >= 0.08).alias("high"), F.count_if((v >= 0.04) & (v < 0.08)).alias("middle"), F.count_if(v < 0.04).alias("low")
    )


@query(
    "A20 U4 X5",
    """WITH s AS (SELECT list_distinct(string_split(lower(p_name), ' ')) AS a, list_distinct(string_split(lower(p_type), ' ')) AS b FROM part), c AS (SELECT len(list_intersect(a, b)) AS tp, len(a) AS na, len(b) AS nb FROM s)
       SELECT sum(tp)::BIGINT AS tp, sum(na - tp)::BIGINT AS fp, sum(nb - tp)::BIGINT AS fn, round(avg(tp::DOUBLE / na), 6) AS macro_p, round(avg(tp::DOUBLE / nb), 6) AS macro_r, round(avg(CASE WHEN tp = 0 THEN 0 ELSE 2.0 * tp / (na + nb) END), 6) AS macro_f1 FROM c""",
)
def a_token_set_scores(t: Tables) -> DataFrame:
    sets = t.part.select(F.array_distinct(F.split(F.lower("p_name"), " ")).alias("a"), F.array_distinct(F.split(F.lower("p_type"), " ")).alias("b"))
    c = sets.select(F.size(F.array_intersect("a", "b")).alias("tp"), F.size("a").alias("na"), F.size("b").alias("nb"))
    return c.agg(
        F.sum("tp").alias("tp"), F.sum(F.col("na") - F.col("tp")).alias("fp"), F.sum(F.col("nb") - F.col("tp")).alias("fn"), F.round(F.avg(F.col("tp") / F.col("na")), 6).alias("macro_p"),
        F.round(F.avg(F.col("tp") / F.col("nb")), 6).alias("macro_r"), F.round(F.avg(F.when(F.col("tp") == 0, 0.0).otherwise(F.lit(2.0) * F.col("tp") / (F.col("na") + F.col("nb")))), 6).alias("macro_f1"),
    )


@query(
    "A21",
    """SELECT round(avg((a.l_returnflag = b.l_returnflag)::INT), 6) AS exact, round(avg((abs(a.l_discount - b.l_discount) <= 0.0200001)::INT), 6) AS close, round(count(b.l_orderkey)::DOUBLE / count(*), 6) AS coverage
       FROM lineitem a LEFT JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1""",
)
def a_accuracy(t: Tables) -> DataFrame:
    a = t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", "l_discount")
    b = t.lineitem.select(F.col("l_orderkey").alias("k"), (F.col("l_linenumber") - 1).alias("n"), F.col("l_returnflag").alias("flag"), F.col("l_discount").alias("value"))
    rows = a.join(b, (F.col("k") == F.col("l_orderkey")) & (F.col("n") == F.col("l_linenumber")), "left")
    return rows.agg(
        F.round(F.avg((F.col("l_returnflag") == F.col("flag")).cast("int")), 6).alias("exact"), F.round(F.avg((F.abs(F.col("l_discount") - F.col("value")) <= 0.0200001).cast("int")), 6).alias("close"),
        F.round(F.count("k") / F.count("*"), 6).alias("coverage"),
    )


@query(
    "A22 ST1",
    """SELECT date_trunc('hour', ts)::TIMESTAMP AS bucket, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events WHERE ts >= TIMESTAMP '2024-01-31' - INTERVAL 7 DAYS GROUP BY 1, 2""",
)
def a_time_bucket(t: Tables) -> DataFrame:
    recent = F.expr("ts >= timestamp_ntz'2024-01-31 00:00:00' - interval 7 days")
    return t.events.filter(recent).groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("bucket"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query(
    "A23",
    """SELECT round(corr(l_quantity, l_extendedprice), 6) AS quantity_price, round(corr(l_quantity, l_discount), 6) AS quantity_discount, round(corr(l_extendedprice, l_tax), 6) AS price_tax FROM lineitem""",
)
def a_corr(t: Tables) -> DataFrame:
    pair = lambda a, b: F.round(F.corr(a, b), 6)
    return t.lineitem.agg(pair("l_quantity", "l_extendedprice").alias("quantity_price"), pair("l_quantity", "l_discount").alias("quantity_discount"), pair("l_extendedprice", "l_tax").alias("price_tax"))


@query(
    "A24",
    """WITH c AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1) SELECT event_type, n, round(n::DOUBLE / sum(n) OVER (), 6) AS share,
       CASE WHEN event_type = 'error' AND n::DOUBLE / sum(n) OVER () > 0.2 THEN 'too many unknown' WHEN event_type = 'view' AND n::DOUBLE / sum(n) OVER () > 0.3 THEN 'too many semantic' ELSE 'ok' END AS verdict FROM c""",
)
def a_distribution_quality(t: Tables) -> DataFrame:
    c = t.events.groupBy("event_type").agg(F.count("*").alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy())
    verdict = F.when((F.col("event_type") == "error") & (share > 0.2), "too many unknown").when((F.col("event_type") == "view") & (share > 0.3), "too many semantic").otherwise("ok")
    return c.select("event_type", "n", F.round(share, 6).alias("share"), verdict.alias("verdict"))


@query(
    "A25 A26",
    """SELECT CASE WHEN grouping(event_type) = 0 THEN 'type' WHEN grouping(user_id) = 0 THEN 'user' ELSE 'all' END AS level, coalesce(event_type, user_id::VARCHAR, '') AS label, count(*) AS n FROM events GROUP BY GROUPING SETS ((event_type), (user_id), ())""",
)
def a_frequency_tables(t: Tables) -> DataFrame:
    rows = t.events.groupingSets([["event_type"], ["user_id"], []], "event_type", "user_id").agg(F.count("*").alias("n"), F.grouping("event_type").alias("ge"), F.grouping("user_id").alias("gu"))
    return rows.select(F.when(F.col("ge") == 0, "type").when(F.col("gu") == 0, "user").otherwise("all").alias("level"), F.coalesce("event_type", F.col("user_id").cast("string"), F.lit("")).alias("label"), "n")


@query(
    "A27",
    """SELECT event_type, count(*) AS n, round(count(*) / greatest((epoch(max(ts)) - epoch(min(ts))) / 60.0, 1), 6) AS per_minute FROM events GROUP BY 1""",
)
def a_throughput(t: Tables) -> DataFrame:
    at = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    minutes = F.greatest((F.max(at) - F.min(at)) / 60.0, F.lit(1.0))
    return t.events.groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.count("*") / minutes, 6).alias("per_minute"))


@query(
    "A28",
    """WITH s AS (SELECT doc_id, CASE WHEN text IS NULL THEN 'MISSING' WHEN length(text) = 0 THEN 'EMPTY' WHEN length(text) < 100 THEN 'SHORT' ELSE 'OK' END AS text_status, CASE WHEN lang IN ('en', 'fr') THEN 'OK' ELSE 'MISSING' END AS lang_status FROM documents)
       SELECT text_status, lang_status, count(*) AS n, count(*) FILTER (WHERE (text_status = 'OK')::INT + (lang_status = 'OK')::INT >= 2) AS n_complete FROM s GROUP BY 1, 2""",
)
def a_artifact_coverage(t: Tables) -> DataFrame:
    text = F.when(F.col("text").isNull(), "MISSING").when(F.length("text") == 0, "EMPTY").when(F.length("text") < 100, "SHORT").otherwise("OK")
    lang = F.when(F.col("lang").isin("en", "fr"), "OK").otherwise("MISSING")
    s = t.documents.select(text.alias("text_status"), lang.alias("lang_status"))
    return s.groupBy("text_status", "lang_status").agg(F.count("*").alias("n"), F.count_if((F.col("text_status") == "OK") & (F.col("lang_status") == "OK")).alias("n_complete"))
