"""Queries on the registry, on sources and sinks, and on streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import registry as R
from ..operators.quantiles import exact_quantiles
from ..sources import tables as S
from ..streaming import backlog as B
from ..streaming import streams as ST
from .registry import Tables, query

# events stand in for the registry's event log; "now" is fixed
_NOW = "2024-01-31 00:00:00"
_STATUS_SQL = "CASE event_type WHEN 'signup' THEN 'PENDING' WHEN 'view' THEN 'PROCESSING' WHEN 'click' THEN 'RETRY' WHEN 'purchase' THEN 'DONE' ELSE 'FAILED' END"


def _log(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    status = F.when(kind == "signup", "PENDING").when(kind == "view", "PROCESSING").when(kind == "click", "RETRY").when(kind == "purchase", "DONE").otherwise("FAILED")
    return t.events.withColumn("status", status)




def _last():
    return F.struct("ts", "event_id")


_FOLD_SQL = f"SELECT user_id, arg_max({_STATUS_SQL}, row(ts, event_id)) AS status, count(*) AS version, max(ts) AS updated FROM events GROUP BY 1"


@query("R2 R8 R1", _FOLD_SQL)
def r_fold_status(t: Tables) -> DataFrame:
    return R.folded(_log(t), "user_id", _last(), "status")


@query(
    "R2",
    f"""WITH f AS ({_FOLD_SQL}) SELECT user_id, CASE WHEN user_id % 2 = 0 THEN 'DONE' ELSE status END AS status, version + (user_id % 2 = 0)::INT AS version, user_id % 2 = 0 AS applied FROM f""",
)
def r_compare_and_set(t: Tables) -> DataFrame:
    rows = R.folded(_log(t), "user_id", _last(), "status")
    expected = F.col("version") + F.when(F.col("user_id") % 2 == 0, 0).otherwise(1)
    return R.compare_and_set(rows, rows.select("user_id", expected.alias("expected"), F.lit("DONE").alias("to_status")), "user_id")


@query(
    "R3",
    f"""WITH f AS (SELECT user_id, count(*) FILTER (WHERE event_type = 'error') AS failures, arg_max({_STATUS_SQL}, row(ts, event_id)) AS status FROM events GROUP BY 1) SELECT user_id, failures, CASE WHEN status = 'FAILED' AND failures % 6 < 4 THEN 'RETRY' ELSE status END AS next_status, (60 * 5 ** (failures % 6))::BIGINT AS wait_s FROM f""",
)
def r_backoff(t: Tables) -> DataFrame:
    f = _log(t).groupBy("user_id").agg(F.count_if(F.col("status") == "FAILED").alias("failures"), F.max_by("status", _last()).alias("status"))
    tries = F.col("failures") % 6
    return f.select("user_id", "failures", F.when((F.col("status") == "FAILED") & (tries < 4), "RETRY").otherwise(F.col("status")).alias("next_status"), R.backoff_seconds(tries).alias("wait_s"))


@query(
    "R4",
    f"""WITH f AS (SELECT user_id, arg_max({_STATUS_SQL}, row(ts, event_id)) AS status, max(ts) FILTER (WHERE event_type = 'click') AS beat FROM events GROUP BY 1) SELECT user_id, beat FROM f WHERE status = 'PROCESSING' AND (beat IS NULL OR epoch_ms(TIMESTAMP '{_NOW}') - epoch_ms(beat) > 300000)""",
)
def r_stale(t: Tables) -> DataFrame:
    f = _log(t).groupBy("user_id").agg(F.max_by("status", _last()).alias("status"), F.max(F.when(F.col("event_type") == "click", F.col("ts"))).alias("beat"))
    age = F.unix_millis(F.lit(_NOW).cast("timestamp")) - F.unix_millis(F.col("beat").cast("timestamp"))
    return f.filter((F.col("status") == "PROCESSING") & (F.col("beat").isNull() | (age > 300_000))).select("user_id", "beat")


@query(
    "R5 T3",
    f"""WITH f AS ({_FOLD_SQL}) SELECT user_id, status FROM f WHERE status <> 'DONE' ORDER BY CASE status WHEN 'RETRY' THEN 0 WHEN 'FAILED' THEN 1 WHEN 'PENDING' THEN 2 ELSE 3 END, updated, user_id LIMIT 50""",
)
def r_queue(t: Tables) -> DataFrame:
    f = R.folded(_log(t), "user_id", _last(), "status").filter("status <> 'DONE'")
    return f.orderBy(R.priority(F.col("status")), "updated", "user_id").limit(50).select("user_id", "status")


@query(
    "R6 A9 W3",
    f"""SELECT ts::DATE AS day, count(*) AS n, count(*) FILTER (WHERE event_type = 'error') AS failed, round(100.0::DOUBLE * count(*) FILTER (WHERE event_type = 'error') / count(*), 1) AS pct, round(median(value), 6) AS mid, round(quantile_cont(value, 0.95), 6) AS p95, round(count(*)::DOUBLE / sum(count(*)) OVER (), 6) AS share FROM events WHERE ts >= TIMESTAMP '{_NOW}' - INTERVAL 30 DAYS GROUP BY 1""",
)
def r_reports(t: Tables) -> DataFrame:
    recent = t.events.filter(F.expr(f"ts >= timestamp_ntz'{_NOW}' - interval 30 days"))
    d = recent.groupBy(F.to_date("ts").alias("day")).agg(
        F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("failed"), F.round(F.lit(100.0) * F.count_if(F.col("event_type") == "error") / F.count("*"), 1).alias("pct"),
    )
    q = exact_quantiles(recent.select(F.to_date("ts").alias("day"), "value"), "day", "value", {"mid": 0.5, "p95": 0.95})
    d = d.join(q, "day", "left").withColumn("mid", F.round("mid", 6)).withColumn("p95", F.round("p95", 6))
    return d.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 6))


@query(
    "R1",
    """WITH old AS (SELECT c_custkey AS k, 1 AS v FROM customer WHERE c_custkey % 2 = 0), new AS (SELECT c_custkey AS k, 2 AS v FROM customer WHERE c_custkey % 3 = 0) SELECT * FROM old UNION ALL SELECT * FROM new WHERE k NOT IN (SELECT k FROM old)""",
)
def r_register(t: Tables) -> DataFrame:
    of = lambda m, v: t.customer.filter(F.col("c_custkey") % m == 0).select(F.col("c_custkey").alias("k"), F.lit(v).alias("v"))
    return R.registered(of(2, 1), of(3, 2), "k")


@query("S16 S19 ST6", "SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN 'new' ELSE 'old' END AS v FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 = 0")
def s_upsert(t: Tables) -> DataFrame:
    of = lambda m, v: t.customer.filter(F.col("c_custkey") % m == 0).select(F.col("c_custkey").alias("k"), F.lit(v).alias("v"))
    return S.upserted(of(2, "old"), of(3, "new"), ["k"])


@query("S1 S2 S3 S12", "SELECT r_name, count(*) AS n FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY 1")
def s_sql_over_views(t: Tables) -> DataFrame:
    S.register_views(t.spark, {f"ms_{n}": f"{t.folder}/{n}.parquet" for n in ("region", "nation")})
    return t.spark.sql("SELECT r_name, count(*) AS n FROM ms_region JOIN ms_nation ON n_regionkey = r_regionkey WHERE n_nationkey >= :least GROUP BY r_name", args={"least": 0})


@query("S4", "SELECT 'nation' AS name, true AS alive UNION ALL SELECT 'absent', false")
def s_liveness(t: Tables) -> DataFrame:
    alive = S.register_views(t.spark, {n: f"{t.folder}/{n}.parquet" for n in ("nation", "absent")})
    return t.spark.createDataFrame(sorted(alive.items()), "name string, alive boolean")


@query("S11 F9", "SELECT o_orderkey::VARCHAR AS id, try_cast(o_orderpriority AS INT) AS priority, o_totalprice::FLOAT::DOUBLE AS price, NULL::VARCHAR AS note FROM orders")
def s_coerced_read(t: Tables) -> DataFrame:
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("priority", T.IntegerType()), T.StructField("price", T.FloatType()), T.StructField("note", T.StringType())])
    renamed = t.orders.withColumnsRenamed({"o_orderkey": "id", "o_orderpriority": "priority", "o_totalprice": "price"})
    return S.coerced(renamed, schema).withColumn("price", F.col("price").cast("double"))


@query("S14", "SELECT o_orderstatus, strftime(o_orderdate, '%Y%m') AS month, count(*) AS n FROM orders GROUP BY 1, 2")
def s_partitioned_export(t: Tables) -> DataFrame:
    place = S.new_place(t.spark, "export")
    rows = t.orders.withColumn("month", F.date_format("o_orderdate", "yyyyMM")).select("o_orderkey", "o_orderstatus", "month")
    S.export_partitioned(rows, place, "o_orderstatus")
    return t.spark.read.parquet(place).groupBy("o_orderstatus", "month").agg(F.count("*").alias("n"))


@query("S12", "SELECT r_regionkey::BIGINT AS r_regionkey, r_name FROM region")
def s_json_round_trip(t: Tables) -> DataFrame:
    place = S.new_place(t.spark, "json")
    t.region.write.json(place)
    back = t.spark.read.schema("r_regionkey long, r_name string, _corrupt_record string").option("mode", "PERMISSIVE").json(place)
    return back.filter("_corrupt_record is null").select("r_regionkey", "r_name")


@query("ST1 ST5", "SELECT date_trunc('hour', ts)::TIMESTAMP AS bucket, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def st_tumbling(t: Tables) -> DataFrame:
    got = ST.latest(ST.run(ST.tumbling(ST.source(t.spark, t.folder, "events")), "update", "tumbling"), ["window", "event_type"])
    return got.select(F.col("window.start").cast("timestamp_ntz").alias("bucket"), "event_type", "n", F.round("total", 4).alias("total"))


@query(
    "ST1",
    """WITH w AS (SELECT unnest([date_trunc('hour', ts), date_trunc('hour', ts) - INTERVAL 1 HOUR]) AS bucket FROM events) SELECT bucket::TIMESTAMP AS bucket, count(*) AS n FROM w GROUP BY 1""",
)
def st_sliding(t: Tables) -> DataFrame:
    got = ST.latest(ST.run(ST.sliding(ST.source(t.spark, t.folder, "events")), "update", "sliding"), ["window"])
    return got.select(F.col("window.start").cast("timestamp_ntz").alias("bucket"), "n")


@query("ST4", "SELECT event_id, user_id FROM events")
def st_once(t: Tables) -> DataFrame:
    return ST.run(ST.once_by_id(ST.source(t.spark, t.folder, "events")), "append", "once").select("event_id", "user_id")


@query(
    "ST3",
    """WITH g AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 30 MINUTES > ts THEN 0 ELSE 1 END AS new FROM events), s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g),
       c AS (SELECT user_id, k, min(ts) AS started, max(ts) AS last, count(*) AS n FROM s GROUP BY 1, 2) SELECT user_id, started, n FROM c WHERE last + INTERVAL 30 MINUTES <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTES""",
)
def st_sessions(t: Tables) -> DataFrame:
    """Stretches of activity that are over for certain: those before the final watermark."""
    got = ST.run(ST.sessions(ST.source(t.spark, t.folder, "events")), "append", "sessions")
    return got.select("user_id", F.col("session_window.start").cast("timestamp_ntz").alias("started"), "n")


def _stamps(t: Tables) -> DataFrame:
    return t.events.select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))


@query("ST7 ST1", "SELECT date_trunc('hour', ts)::TIMESTAMP AS bucket, count(*) AS n FROM events GROUP BY 1")
def st_limited(t: Tables) -> DataFrame:
    """Hourly counts of a backlog of ten files, three a batch, in order of time; the stream is stopped after two batches and started again."""
    place, rows = S.new_place(t.spark, "limited"), _stamps(t)
    B.in_order(rows, f"{place}/inbox", "ts", 10)
    for batches in (2, None):
        counts = B.limited(t.spark, f"{place}/inbox", rows.schema, 3).withWatermark("ts", "10 minutes").groupBy(F.window("ts", "1 hour")).agg(F.count("*").alias("n"))
        B.go_on(counts, "update", place, lambda b, k: b.write.mode("overwrite").parquet(f"{place}/out/batch={k:06d}"), batches)
    got = ST.latest(t.spark.read.parquet(f"{place}/out"), ["window"])
    return got.select(F.col("window.start").cast("timestamp_ntz").alias("bucket"), "n")


@query("ST2", "SELECT event_id, CASE WHEN day(ts) <= 15 THEN 1 ELSE 2 END AS start FROM events")
def st_new_files(t: Tables) -> DataFrame:
    """Two starts from one checkpoint: the second takes only the files that came after the first."""
    place, rows = S.new_place(t.spark, "new-files"), _stamps(t)
    for start, part in ((1, F.dayofmonth("ts") <= 15), (2, F.dayofmonth("ts") > 15)):
        B.in_order(rows.filter(part), f"{place}/inbox", "ts", 4)
        stream = B.limited(t.spark, f"{place}/inbox", rows.schema, 2).select("event_id")
        B.go_on(stream, "append", place, lambda b, k, start=start: b.write.mode("overwrite").parquet(f"{place}/out/start={start}/batch={k:06d}"))
    return t.spark.read.option("basePath", f"{place}/out").parquet(f"{place}/out/start=*").select("event_id", F.col("start").cast("int").alias("start"))


@query(
    "ST3",
    """WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 2 HOURS THEN 0 ELSE 1 END AS new FROM events), s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g),
       c AS (SELECT user_id, max(ts) AS last, count(*) AS n, k = max(k) OVER (PARTITION BY user_id) AS final FROM s GROUP BY user_id, k) SELECT user_id, last, n FROM c WHERE NOT final OR last + INTERVAL 2 HOURS < (SELECT max(ts) FROM events) - INTERVAL 10 MINUTES""",
)
def st_quiet_workers(t: Tables) -> DataFrame:
    """Workers reset because they gave no sign for two hours: by the timer of their state, or where the next sign tells it."""
    place, rows = S.new_place(t.spark, "quiet"), _stamps(t)
    B.in_order(rows, f"{place}/inbox", "ts", 6)
    with B.rocks_state(t.spark):
        found = B.quiet(B.limited(t.spark, f"{place}/inbox", rows.schema, 2), "user_id", "ts", 7_200_000, "10 minutes")
        B.go_on(found, "append", place, lambda b, k: b.write.mode("overwrite").parquet(f"{place}/out/batch={k:06d}"))
    return t.spark.read.parquet(f"{place}/out").select(F.col("worker").alias("user_id"), F.col("last").cast("timestamp_ntz").alias("last"), "n")
