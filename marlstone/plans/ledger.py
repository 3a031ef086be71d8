"""Queries on registrations, migrations and manifests, on reports, and on sources and sinks of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import registry as R
from ..operators.quantiles import exact_quantiles
from ..sources import tables as S
from .registry import Tables, query


@query(
    "R1",
    """WITH given AS (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderkey % 5 < 2 GROUP BY 1), old AS (SELECT c_custkey AS k FROM customer WHERE c_custkey % 3 = 0) SELECT count(*) FILTER (WHERE k NOT IN (SELECT k FROM old)) AS inserted, count(*) FILTER (WHERE k IN (SELECT k FROM old)) AS skipped, sum(n - 1)::BIGINT AS repeated FROM given""",
)
def r_bulk_register(t: Tables) -> DataFrame:
    """What a bulk registration would do, in numbers."""
    new = t.orders.filter("o_orderkey % 5 < 2").select(F.col("o_custkey").alias("k"))
    return R.register_counts(t.customer.filter("c_custkey % 3 = 0").select(F.col("c_custkey").alias("k")), new, "k")


@query(
    "R9",
    """SELECT c_custkey, 3 AS schema_version, CASE WHEN c_custkey % 4 = 3 THEN 'kept' WHEN c_custkey % 4 = 0 THEN lower(c_mktsegment) ELSE c_mktsegment END AS segment, CASE WHEN c_custkey % 4 < 3 THEN 0 END AS retries FROM customer""",
)
def r_migrations(t: Tables) -> DataFrame:
    """Rows of four schema versions at the last one: the second writes segments in lower case, the third adds retries."""
    k = F.col("c_custkey") % 4
    rows = t.customer.select("c_custkey", k.cast("int").alias("schema_version"), F.when(k == 3, "kept").otherwise(F.col("c_mktsegment")).alias("segment"))
    return R.migrated(rows, [(3, {"retries": F.lit(0)}), (1, {"segment": F.lower("segment")})])


@query(
    "R10",
    """WITH m AS (SELECT o_orderkey AS k, unnest(CASE o_orderkey % 3 WHEN 0 THEN ['parse'] WHEN 1 THEN ['parse', 'index'] ELSE [] END) AS stage, o_orderstatus AS s, md5(CASE WHEN o_orderkey % 7 = 0 THEN 'old' ELSE o_orderpriority END) AS h FROM orders), w AS (SELECT o_orderkey AS k, md5(o_orderpriority) AS now, unnest(['parse', 'facts', 'index']) AS stage FROM orders)
       SELECT w.k, w.stage, CASE WHEN h IS NULL THEN 'pending' WHEN h <> now THEN 'stale' WHEN s = 'F' THEN 'failed' ELSE 'done' END AS state, state = 'done' AS done FROM w LEFT JOIN m ON m.k = w.k AND m.stage = w.stage""",
)
def r_manifest(t: Tables) -> DataFrame:
    """States of stages, stale where they ran with other settings."""
    k = F.col("o_orderkey")
    ran = F.when(k % 3 == 0, F.array(F.lit("parse"))).when(k % 3 == 1, F.array(F.lit("parse"), F.lit("index")))
    manifest = t.orders.select(k.alias("k"), F.explode(ran).alias("stage"), F.when(F.col("o_orderstatus") == "F", "failed").otherwise("done").alias("status"), F.md5(F.when(k % 7 == 0, "old").otherwise(F.col("o_orderpriority"))).alias("hash"))
    return R.stage_states(manifest, t.orders.select(k.alias("k"), F.md5("o_orderpriority").alias("hash")), "k", ["parse", "facts", "index"])


@query(
    "R6 A9 A10",
    """SELECT event_type, count(*) AS n, round(avg(value), 6) AS mean, round(median(value), 6) AS mid, round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.99), 6) AS p99, max(value) AS most FROM events GROUP BY 1""",
)
def r_runtime_report(t: Tables) -> DataFrame:
    """Runtimes by stage."""
    sums = t.events.groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.avg("value"), 6).alias("mean"), F.max("value").alias("most"))
    shares = exact_quantiles(t.events, "event_type", "value", {"mid": 0.5, "p95": 0.95, "p99": 0.99})
    return sums.join(shares, "event_type").select("event_type", "n", "mean", *[F.round(c, 6).alias(c) for c in ("mid", "p95", "p99")], "most")


@query(
    "R6 W3",
    """WITH f AS (SELECT json_extract(props, '$.k')::DOUBLE::INT % 7 AS cause, count(*) AS n, max(ts) AS last FROM events WHERE event_type = 'error' GROUP BY 1) SELECT cause, n, round(100.0 * n / sum(n) OVER (), 2)::DOUBLE AS pct, last FROM f""",
)
def r_failure_report(t: Tables) -> DataFrame:
    """Failures by cause, with their shares."""
    cause = F.pmod(F.get_json_object("props", "$.k").cast("double").cast("int"), F.lit(7))
    f = t.events.filter("event_type = 'error'").groupBy(cause.alias("cause")).agg(F.count("*").alias("n"), F.max("ts").alias("last"))
    total = F.sum("n").over(Window.partitionBy())  # over seven rows
    return f.select("cause", "n", F.round(100.0 * F.col("n") / total, 2).alias("pct"), "last")


@query(
    "R6 A22 A27",
    """SELECT date_trunc('hour', ts)::TIMESTAMP AS hour, count(*) AS n, count(*) FILTER (WHERE event_type = 'purchase') AS done, round(count(*) FILTER (WHERE event_type = 'purchase') / 60.0, 4)::DOUBLE AS per_minute FROM events GROUP BY 1""",
)
def r_throughput_report(t: Tables) -> DataFrame:
    """Work done by hour."""
    done = F.count_if(F.col("event_type") == "purchase")
    return t.events.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")).agg(F.count("*").alias("n"), done.alias("done"), F.round(done / 60.0, 4).alias("per_minute"))


@query(
    "R6 R4",
    """SELECT user_id % 16 AS worker, count(*) AS n, count(*) FILTER (WHERE event_type = 'error') AS failed, count(DISTINCT user_id) AS papers, min(ts) AS first_seen, max(ts) AS last_seen, epoch_ms(max(ts)) < epoch_ms((SELECT max(ts) FROM events)) - 300000 AS quiet FROM events GROUP BY 1""",
)
def r_worker_report(t: Tables) -> DataFrame:
    """Workers: what they did, when, and whether they fell quiet."""
    end = t.events.agg(F.max(F.unix_millis(F.col("ts").cast("timestamp"))).alias("end")).first().end or 0
    w = t.events.groupBy((F.col("user_id") % 16).alias("worker")).agg(
        F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("failed"), F.count_distinct("user_id").alias("papers"), F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen")
    )
    return w.withColumn("quiet", F.unix_millis(F.col("last_seen").cast("timestamp")) < F.lit(end - 300_000))


@query("S5", "SELECT n_nationkey::BIGINT AS id, n_name AS name FROM nation WHERE n_nationkey <> 7 ORDER BY n_name LIMIT 10")
def s_json_folder(t: Tables) -> DataFrame:
    """One JSON document a file, one of them broken, in order of path, ten of them."""
    place = S.new_place(t.spark, "documents")
    good = F.to_json(F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name")))
    t.nation.select(F.when(F.col("n_nationkey") == 7, '{"id": 7, "name').otherwise(good).alias("value"), F.col("n_name").alias("file")).write.partitionBy("file").text(place)
    return S.read_json_documents(t.spark, place, "id long, name string", 10).select("id", "name")


@query("S6", "SELECT CASE r_regionkey % 3 WHEN 0 THEN 'm' WHEN 1 THEN 'p' ELSE 's' END || r_regionkey AS paper_id, CASE WHEN r_regionkey % 2 = 0 THEN 'enriched' ELSE 'parsed' END AS source FROM region")
def s_source_fallback(t: Tables) -> DataFrame:
    """Enriched documents where there are any, else parsed ones; the id from one of three places."""
    k = F.col("r_regionkey").cast("string")
    body = F.when(k.cast("int") % 3 == 0, F.concat(F.lit('{"metadata":{"paper_id":"m'), k, F.lit('"}}'))).when(k.cast("int") % 3 == 1, F.concat(F.lit('{"paper":{"metadata":{"paper_id":"p'), k, F.lit('"}}}'))).otherwise(F.concat(F.lit('{"other":1,"stem":"s'), k, F.lit('"}')))

    def written(rows: DataFrame, name: str) -> DataFrame:
        place = S.new_place(t.spark, name)
        rows.select(body.alias("value")).write.text(place)
        meta = "metadata struct<paper_id:string>"
        back = t.spark.read.schema(f"{meta}, paper struct<{meta}>, stem string").json(place)
        return back.select(F.coalesce("metadata.paper_id", "paper.metadata.paper_id", "stem").alias("paper_id"), F.lit(name).alias("source"))

    return S.with_fallback(written(t.region.filter("r_regionkey % 2 = 0"), "enriched"), written(t.region, "parsed"), "paper_id")


@query("S13", "SELECT n_nationkey, n_name, substr(sha256('rules=3;model=a'), 1, 16) AS pipeline_hash, TIMESTAMP '2024-01-31 00:00:00' AS created_at FROM nation")
def s_stamped(t: Tables) -> DataFrame:
    """A table stamped with what it was made with."""
    place = S.new_place(t.spark, "stamped")
    S.stamped(t.nation.select("n_nationkey", "n_name"), "rules=3;model=a", "2024-01-31 00:00:00").write.parquet(place)
    return t.spark.read.parquet(place).withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))


@query("S15", "SELECT strftime(ts, '%Y%m') AS month, count(*) AS n, min(event_id) AS first_id FROM events WHERE strftime(ts, '%Y%m') = '202401' GROUP BY 1")
def s_monthly_audit(t: Tables) -> DataFrame:
    """The audit of one month, exported by month in order of time and read again."""
    place = S.new_place(t.spark, "audit")
    month = F.date_format("ts", "yyyyMM")
    t.events.withColumn("month", month).filter("month = '202401'").repartitionByRange("month", "ts").sortWithinPartitions("month", "ts").write.partitionBy("month").option("compression", "zstd").parquet(place)
    return t.spark.read.schema("event_id long, month string").parquet(place).groupBy("month").agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"))


@query(
    "S17",
    """SELECT 'csv' AS sink, count(*) AS n, md5(string_agg(n_name || ',' || n_regionkey, ';' ORDER BY n_name)) AS digest FROM nation UNION ALL SELECT 'json', count(*), md5(string_agg(n_name || ',' || n_regionkey, ';' ORDER BY n_name)) FROM nation
       UNION ALL SELECT 'markdown', count(*) + 2, md5('| n_name | n_regionkey |;|---|---|;' || string_agg('| ' || n_name || ' | ' || n_regionkey || ' |', ';' ORDER BY n_name)) FROM nation""",
)
def s_report_sinks(t: Tables) -> DataFrame:
    """One report as CSV, JSON lines and a Markdown table, each read again."""
    rows, place = t.nation.select("n_name", "n_regionkey"), S.new_place(t.spark, "report")
    rows.write.option("header", "true").csv(f"{place}/csv")
    rows.write.json(f"{place}/json")
    S.markdown_table(rows).coalesce(1).orderBy("ord", "line").select("line").write.text(f"{place}/markdown")  # a report, meant to be read
    schema = "n_name string, n_regionkey long"
    told = F.concat_ws(",", "n_name", "n_regionkey")
    whole = lambda df, c, by, sink: df.agg(F.lit(sink).alias("sink"), F.count("*").alias("n"), F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(by.alias("o"), c.alias("c")))), lambda x: x["c"]), ";")).alias("digest"))
    lines = t.spark.read.text(f"{place}/markdown")
    at = F.when(F.col("value").startswith("| n_name"), 0).when(F.col("value").startswith("|---"), 1).otherwise(2)
    out = whole(t.spark.read.schema(schema).option("header", "true").csv(f"{place}/csv"), told, F.col("n_name"), "csv")
    out = out.union(whole(t.spark.read.schema(schema).json(f"{place}/json"), told, F.col("n_name"), "json"))
    return out.union(whole(lines, F.col("value"), F.struct(at, "value"), "markdown"))


@query("S23", "SELECT c_custkey % 3 AS batch, count(*) AS n, count(*) AS n_csv FROM customer WHERE c_custkey % 3 < 2 GROUP BY 1")
def s_run_log(t: Tables) -> DataFrame:
    """Two runs added to one log, read from both of its forms."""
    place = S.new_place(t.spark, "log")
    for batch in range(2):
        S.append_log(t.customer.filter(F.col("c_custkey") % 3 == batch).select(F.col("c_custkey").alias("id"), F.lit(batch).cast("long").alias("batch"), F.lit("ok").alias("status")), place)
    schema = "id long, batch long, status string"
    csv = t.spark.read.schema(schema).option("header", "true").csv(f"{place}/csv").groupBy("batch").agg(F.count("*").alias("n_csv"))
    return t.spark.read.schema(schema).json(f"{place}/jsonl").groupBy("batch").agg(F.count("*").alias("n")).join(csv, "batch")


@query(
    "S18 G2",
    """WITH old AS (SELECT l_orderkey AS src, l_partkey AS dst, max(l_discount) AS confidence FROM lineitem WHERE l_linenumber <= 3 GROUP BY 1, 2), new AS (SELECT l_orderkey AS src, l_partkey AS dst, max(l_tax) AS confidence FROM lineitem WHERE l_linenumber >= 3 GROUP BY 1, 2)
       SELECT src, dst, max(confidence) AS confidence FROM (SELECT * FROM old UNION ALL SELECT * FROM new) GROUP BY 1, 2""",
)
def s_graph_merge(t: Tables) -> DataFrame:
    """Edges merged into those there are by their ends, twice, which changes nothing."""
    of = lambda where, c: t.lineitem.filter(where).groupBy(F.col("l_orderkey").alias("src"), F.col("l_partkey").alias("dst")).agg(F.max(c).alias("confidence"))
    old, new = of("l_linenumber <= 3", "l_discount"), of("l_linenumber >= 3", "l_tax")
    once = S.merged_graph(old, new, ["src", "dst"], F.col("confidence"))
    return S.merged_graph(once, new, ["src", "dst"], F.col("confidence"))
