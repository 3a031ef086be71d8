"""Queries on text extraction, ontology and validation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import chunking as C
from .registry import Tables, query


@query(
    "E1 W6 X15",
    """WITH d AS (SELECT doc_id, text, length(text) AS n FROM documents), s AS (SELECT doc_id, text, n, unnest(range(0, greatest(ceil((n - 2000) / 1700.0)::BIGINT, 0) + 1)) * 1700 AS s FROM d), c AS (SELECT doc_id, s, n, substr(text, s + 1, 2000) AS c FROM s),
       k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY s) - 1 AS i FROM c WHERE length(regexp_replace(c, '^\\s+|\\s+$', '', 'g')) >= 120) SELECT doc_id || '::c' || i AS chunk_id, doc_id, i::INT AS chunk_index, s::BIGINT AS char_start, least(s + 2000, n)::BIGINT AS char_end, md5(c) AS digest FROM k""",
)
def e_window_chunks(t: Tables) -> DataFrame:
    return C.windows(t.documents, "doc_id", "text").withColumn("digest", F.md5("chunk")).drop("chunk")


@query(
    "E3 X16 W6",
    """WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents), h AS (SELECT *, CASE WHEN length(trim(line)) BETWEEN 1 AND 40 AND trim(line) LIKE '%.' THEN trim(line) END AS h FROM l),
       f AS (SELECT *, coalesce(last_value(h IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING), '') AS section FROM h) SELECT doc_id, section, count(*) AS n_lines, md5(string_agg(line, chr(10) ORDER BY i)) AS digest FROM f WHERE h IS NULL GROUP BY 1, 2""",
)
def e_sections(t: Tables) -> DataFrame:
    lines = t.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("i", "line"))
    bare = F.trim("line")
    return C.sections(lines, "doc_id", "i", "line", F.when(F.length(bare).between(1, 40) & bare.endswith("."), bare)).select("doc_id", "section", "n_lines", F.md5("body").alias("digest"))


@query(
    "E17 X9 X10 X11 X12 D15",
    """WITH d AS (SELECT doc_id, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS t FROM documents), e AS (SELECT doc_id, entropy(c) AS e FROM (SELECT doc_id, unnest(string_split(t, '')) AS c FROM d) WHERE c <> '' GROUP BY 1),
       w AS (SELECT doc_id, list_filter(regexp_split_to_array(t, '\\s+'), lambda x: x <> '') AS w FROM d), g AS (SELECT doc_id, len(w) AS n, unnest(list_transform(range(1, greatest(len(w) - 3, 2)), lambda i: array_to_string(list_slice(w, i, i + 4), ' '))) AS g FROM w),
       r AS (SELECT doc_id, CASE WHEN max(n) > 5 THEN max(k)::DOUBLE / (max(n) - 4) ELSE 0 END AS r FROM (SELECT doc_id, n, g, count(*) AS k FROM g GROUP BY ALL) GROUP BY 1),
       q AS (SELECT d.doc_id, t, length(t) AS n, coalesce(e, 0) AS e, coalesce(r, 0) AS r, length(t) >= 160 AND (length(t) - length(replace(t, substr(t, 1, 80), ''))) / 80.0 >= 4 AS st,
         regexp_matches(t, '(?i)\\[MISSING\\]|\\[ILLEGIBLE\\]|\\[UNK\\]') AS m, CASE WHEN length(t) > 0 THEN (length(t) - length(translate(t, '\\${}[]_^', '')))::DOUBLE / length(t) ELSE 0 END AS s FROM d LEFT JOIN e ON e.doc_id = d.doc_id LEFT JOIN r ON r.doc_id = d.doc_id)
       SELECT doc_id, round(CASE WHEN n = 0 THEN 0 ELSE greatest(0, least(1, 1 - (CASE WHEN n < 15 THEN 0.40 ELSE 0 END + CASE WHEN st OR r > 0.15 THEN 0.55 ELSE 0 END + CASE WHEN st AND r > 0.40 THEN 0.20 ELSE 0 END + CASE WHEN e < 3.0 THEN greatest(0.10, 0.30 * (1 - e / 3.0)) ELSE 0 END
         + CASE WHEN m THEN 0.25 ELSE 0 END + CASE WHEN s > 0.25 THEN 0.20 ELSE 0 END))) END, 4)::DOUBLE AS score,
       array_to_string(list_filter([CASE WHEN n = 0 THEN 'EMPTY' END, CASE WHEN n BETWEEN 1 AND 14 THEN 'TOO_SHORT' END, CASE WHEN n > 0 AND (st OR r > 0.15) THEN 'REPETITION_LOOP' END, CASE WHEN n > 0 AND e < 3.0 THEN 'LOW_ENTROPY' END, CASE WHEN m THEN 'UNREADABLE' END, CASE WHEN s > 0.25 THEN 'LATEX_OVERFLOW' END], lambda x: x IS NOT NULL), ',') AS flags FROM q""",
)
def e_quality_gate(t: Tables) -> DataFrame:
    score, flags = C.quality_gate(F.col("text"))
    rows = t.documents.select("doc_id", F.struct(score.alias("score"), flags.alias("flags")).alias("q"))
    return rows.select("doc_id", F.round("q.score", 4).alias("score"), F.array_join("q.flags", ",").alias("flags"))


_HAS = {"title": (r"(?i)<title>", 0.15), "nav": (r"(?i)<nav", 0.10), "paragraph": (r"(?i)<p[ >]", 0.30), "link": (r"(?i)<a ", 0.20), "heading": (r"(?i)<h[1-3]", 0.15), "comment": ("<!--", 0.10)}


@query(
    "E18 E20",
    "WITH s AS (SELECT page_id, round(" + " + ".join(f"CASE WHEN regexp_matches(html, '{p}') THEN {w} ELSE 0 END" for p, w in _HAS.values()) + ", 3)::DOUBLE AS score FROM pages) SELECT page_id, score, CASE WHEN score < 0.4 THEN 'augment' WHEN score < 0.8 THEN 'review' ELSE 'use' END AS route FROM s",
)
def e_doc_score(t: Tables) -> DataFrame:
    score = F.round(sum((F.when(F.col("html").rlike(p), w).otherwise(F.lit(0.0)) for p, w in _HAS.values()), F.lit(0.0)), 3)
    rows = t.pages.select("page_id", score.alias("score"))
    return rows.withColumn("route", F.when(F.col("score") < 0.4, "augment").when(F.col("score") < 0.8, "review").otherwise("use"))


@query(
    "F8",
    """SELECT page_id, regexp_extract(html, '(?is)<title>(.*?)</title>', 1) AS title, regexp_extract(html, '(?i)<html[^>]*lang="([a-z]+)"', 1) AS lang, len(regexp_extract_all(html, '(?i)<a [^>]*href='))::BIGINT AS n_links,
       len(regexp_extract_all(html, '(?i)<p[ >]'))::BIGINT AS n_paragraphs, md5(trim(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g'))) AS body FROM pages""",
)
def s_markup_parse(t: Tables) -> DataFrame:
    html = F.col("html")
    bare = F.regexp_replace(F.regexp_replace(html, r"(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->", " "), "<[^>]*>", " ")
    return t.pages.select(
        "page_id", F.regexp_extract(html, r"(?is)<title>(.*?)</title>", 1).alias("title"), F.regexp_extract(html, r'(?i)<html[^>]*lang="([a-z]+)"', 1).alias("lang"),
        F.size(F.regexp_extract_all(html, F.lit(r"(?i)<a [^>]*href="), F.lit(0))).cast("long").alias("n_links"), F.size(F.regexp_extract_all(html, F.lit("(?i)<p[ >]"), F.lit(0))).cast("long").alias("n_paragraphs"),
        F.md5(F.trim(F.regexp_replace(bare, r"\s+", " "))).alias("body"),
    )


@query(
    "M7",
    """WITH m AS (SELECT doc_id, try_cast(regexp_extract(text, '([0-9]+)@mail', 1) AS DOUBLE) AS v FROM documents) SELECT doc_id, v, v BETWEEN 0 AND 50 AS plausible FROM m WHERE v IS NOT NULL""",
)
def e_metric_scan(t: Tables) -> DataFrame:
    v = F.regexp_extract("text", "([0-9]+)@mail", 1).try_cast("double")
    return t.documents.select("doc_id", v.alias("v")).filter("v is not null").withColumn("plausible", F.col("v").between(0, 50))


@query(
    "J20",
    """WITH k AS (SELECT * FROM (VALUES ('the', 'en'), ('der', 'de'), ('que', 'es'), ('les', 'fr')) v(word, sense)), h AS (SELECT doc_id, unnest(string_split(text, ' ')) AS w, generate_subscripts(string_split(text, ' '), 1) AS i FROM documents)
       SELECT doc_id, sense, min(i)::INT AS first_at, count(*) AS n FROM h JOIN k ON lower(w) = word GROUP BY 1, 2""",
)
def e_gazetteer(t: Tables) -> DataFrame:
    # an equi join on words instead of a pattern for each entry
    entries = t.spark.createDataFrame([("the", "en"), ("der", "de"), ("que", "es"), ("les", "fr")], "word string, sense string")
    words = t.documents.select("doc_id", F.posexplode(F.split("text", " ")).alias("i", "w")).withColumn("word", F.lower("w"))
    return words.join(F.broadcast(entries), "word").groupBy("doc_id", "sense").agg((F.min("i") + 1).alias("first_at"), F.count("*").alias("n"))


@query(
    "O6",
    """WITH h AS (SELECT doc_id, text, (contains(text, ' the '))::INT + (contains(text, ' and '))::INT - (contains(text, ' der '))::INT AS en, (contains(text, ' der '))::INT + (contains(text, ' und '))::INT - (contains(text, ' the '))::INT AS de FROM documents)
       SELECT doc_id, CASE WHEN en > 0 AND en >= de THEN 'en' WHEN de > 0 THEN 'de' ELSE 'default' END AS sense, CASE WHEN en > 0 OR de > 0 THEN 0.65 ELSE 0.50 END::DOUBLE AS confidence FROM h""",
)
def e_disambiguate(t: Tables) -> DataFrame:
    has = lambda w: F.col("text").contains(w).cast("int")
    rows = t.documents.select("doc_id", (has(" the ") + has(" and ") - has(" der ")).alias("en"), (has(" der ") + has(" und ") - has(" the ")).alias("de"))
    sense = F.when((F.col("en") > 0) & (F.col("en") >= F.col("de")), "en").when(F.col("de") > 0, "de").otherwise("default")
    return rows.select("doc_id", sense.alias("sense"), F.when((F.col("en") > 0) | (F.col("de") > 0), 0.65).otherwise(0.50).alias("confidence"))


@query(
    "E27",
    """WITH v AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'yes' WHEN 1 THEN 'False' WHEN 2 THEN '1' ELSE 'maybe' END AS accepted, value / 50 AS conf FROM events) SELECT event_id, CASE WHEN lower(accepted) IN ('true', 'yes', '1') THEN true WHEN lower(accepted) IN ('false', 'no', '0') THEN false END AS accepted,
       round(CASE WHEN conf BETWEEN 0 AND 1 THEN conf ELSE 0 END, 6) AS confidence FROM v""",
)
def e_verdict_coercion(t: Tables) -> DataFrame:
    k = F.col("event_id") % 4
    raw = F.lower(F.when(k == 0, "yes").when(k == 1, "False").when(k == 2, "1").otherwise("maybe"))
    conf = F.col("value") / 50
    accepted = F.when(raw.isin("true", "yes", "1"), True).when(raw.isin("false", "no", "0"), False)
    return t.events.select("event_id", accepted.alias("accepted"), F.round(F.when(conf.between(0, 1), conf).otherwise(F.lit(0.0)), 6).alias("confidence"))


@query(
    "S16",
    """SELECT coalesce(a.o_custkey, b.c_custkey) AS k, coalesce(a.status, b.segment) AS label, (a.status IS NOT NULL)::INT + (b.segment IS NOT NULL)::INT AS sources FROM (SELECT o_custkey, max(o_orderstatus) AS status FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1) a FULL JOIN (SELECT c_custkey, c_mktsegment AS segment FROM customer WHERE c_acctbal > 0) b ON a.o_custkey = b.c_custkey""",
)
def e_hybrid_merge(t: Tables) -> DataFrame:
    a = t.orders.filter("o_orderstatus <> 'F'").groupBy("o_custkey").agg(F.max("o_orderstatus").alias("status"))
    b = t.customer.filter("c_acctbal > 0").select("c_custkey", F.col("c_mktsegment").alias("segment"))
    rows = a.join(b, F.col("o_custkey") == F.col("c_custkey"), "full")
    sources = F.col("status").isNotNull().cast("int") + F.col("segment").isNotNull().cast("int")
    return rows.select(F.coalesce("o_custkey", "c_custkey").alias("k"), F.coalesce("status", "segment").alias("label"), sources.alias("sources"))


@query(
    "E42",
    """SELECT o_orderkey, o_orderstatus, coalesce(n_lines, 0) AS n_lines, coalesce(flags, '') AS flags, coalesce(has_return, false) AS has_return FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n_lines, string_agg(DISTINCT l_returnflag, '' ORDER BY l_returnflag) AS flags, bool_or(l_returnflag = 'R') AS has_return FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""",
)
def e_summary(t: Tables) -> DataFrame:
    per = t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("l_returnflag")), "").alias("f"), F.max(F.col("l_returnflag") == "R").alias("r"))
    rows = t.orders.join(per, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return rows.select("o_orderkey", "o_orderstatus", F.coalesce("n", F.lit(0)).alias("n_lines"), F.coalesce("f", F.lit("")).alias("flags"), F.coalesce("r", F.lit(False)).alias("has_return"))


@query(
    "O3",
    """WITH alias AS (SELECT DISTINCT p_name AS name, lower(replace(p_name, ' ', '_')) AS slug FROM part), q AS (SELECT p_partkey, lower(replace(CASE p_partkey % 3 WHEN 0 THEN p_name WHEN 1 THEN p_name || ' model' ELSE 'new ' || p_name || ' data' END, ' ', '_')) AS s, p_name FROM part)
       SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'exact' WHEN 1 THEN 'stripped' ELSE 'phrase' END AS how, lower(replace(p_name, ' ', '_')) AS slug FROM q""",
)
def o_alias_resolve(t: Tables) -> DataFrame:
    """A name against the aliases: as it is, without noise words at its end, then its longest and leftmost part of two words or more."""
    noise = ["data", "model", "method", "product"]
    alias = t.part.select(X.slug(F.col("p_name")).alias("slug")).distinct()
    k = F.col("p_partkey") % 3
    raw = F.when(k == 0, F.col("p_name")).when(k == 1, F.concat("p_name", F.lit(" model"))).otherwise(F.concat(F.lit("new "), "p_name", F.lit(" data")))
    words = F.split(X.slug(raw), "_")
    rows = t.part.select("p_partkey", words.alias("w"))
    bare = F.expr(f"slice(w, 1, size(w) - if(array_contains(array({', '.join(repr(n) for n in noise)}), element_at(w, -1)), 1, 0))")
    spans = F.expr(
        "flatten(transform(sequence(1, size(w)), i -> transform(filter(sequence(2, size(w)), n -> i + n - 1 <= size(w)), n -> struct(3 as p, -n as n, i as i, array_join(slice(w, i, n), '_') as s))))"
    )
    tries = F.concat(
        F.array(F.struct(F.lit(1).alias("p"), F.lit(0).alias("n"), F.lit(0).alias("i"), F.array_join("w", "_").alias("s")), F.struct(F.lit(2).alias("p"), F.lit(0).alias("n"), F.lit(0).alias("i"), F.array_join(bare, "_").alias("s"))), spans
    )
    hit = rows.select("p_partkey", F.explode(tries).alias("x")).join(alias, F.col("x.s") == F.col("slug")).groupBy("p_partkey").agg(F.min("x").alias("b"))
    return hit.select("p_partkey", F.when(F.col("b.p") == 1, "exact").when(F.col("b.p") == 2, "stripped").otherwise("phrase").alias("how"), F.col("b.s").alias("slug"))


@query(
    "O7",
    """SELECT p_name, max(p_size) AS best_size, string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) AS brands, first(p_type ORDER BY length(p_type) DESC, p_partkey) AS longest FROM part GROUP BY 1""",
)
def o_merge_sources(t: Tables) -> DataFrame:
    longest = F.max_by("p_type", F.struct(F.length("p_type"), -F.col("p_partkey")))
    return t.part.groupBy("p_name").agg(F.max("p_size").alias("best_size"), F.array_join(F.array_sort(F.collect_set("p_brand")), ",").alias("brands"), longest.alias("longest"))


@query(
    "O8 O9",
    """SELECT 'shared_alias' AS rule, p_name AS subject, count(DISTINCT p_type) AS n FROM part GROUP BY p_name HAVING count(DISTINCT p_type) > 1 UNION ALL SELECT 'orphan', l_partkey::VARCHAR, count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part) GROUP BY 2
       UNION ALL SELECT 'no_orders', c_custkey::VARCHAR, 1 FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)""",
)
def o_validate(t: Tables) -> DataFrame:
    shared = t.part.groupBy("p_name").agg(F.countDistinct("p_type").alias("n")).filter("n > 1").select(F.lit("shared_alias").alias("rule"), F.col("p_name").alias("subject"), "n")
    orphan = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"), "left_anti").groupBy("l_partkey").agg(F.count("*").alias("n")).select(F.lit("orphan"), F.col("l_partkey").cast("string"), "n")
    idle = t.customer.join(t.orders, F.col("o_custkey") == F.col("c_custkey"), "left_anti").select(F.lit("no_orders"), F.col("c_custkey").cast("string"), F.lit(1).cast("long"))
    return shared.union(orphan).union(idle)


@query(
    "EP2 F13",
    """SELECT 'documents' AS tab, 'text' AS col, count(*) FILTER (WHERE text IS NULL) AS n_null, count(*) FILTER (WHERE text = '') AS n_empty, count(*) AS n FROM documents UNION ALL SELECT 'documents', 'lang', count(*) FILTER (WHERE lang IS NULL), count(*) FILTER (WHERE lang = ''), count(*) FROM documents
       UNION ALL SELECT 'pages', 'url', count(*) FILTER (WHERE url IS NULL), count(*) FILTER (WHERE url = ''), count(*) FROM pages""",
)
def v_validate_columns(t: Tables) -> DataFrame:
    # one scan a table: counts of all its columns at once, then unpivoted
    def checked(name: str, df: DataFrame, cols: list[str]) -> DataFrame:
        counts = [F.struct(F.lit(c).alias("col"), F.count_if(F.col(c).isNull()).alias("n_null"), F.count_if(F.col(c) == "").alias("n_empty"), F.count("*").alias("n")) for c in cols]
        return df.agg(F.array(*counts).alias("x")).select(F.lit(name).alias("tab"), F.explode("x").alias("x")).select("tab", "x.*")

    return checked("documents", t.documents, ["text", "lang"]).union(checked("pages", t.pages, ["url"]))


@query(
    "A21",
    """WITH p AS (SELECT doc_id, CASE WHEN n_chars >= 200 AND lang IN ('en', 'fr', 'de', 'es') THEN 1 ELSE 0 END AS pred FROM documents) SELECT count(*) AS n, round(avg((pred = quality)::INT), 6) AS accuracy, count(*) FILTER (WHERE pred = 1 AND quality = 1) AS tp, count(*) FILTER (WHERE pred = 1 AND quality = 0) AS fp, count(*) FILTER (WHERE pred = 0 AND quality = 1) AS fn FROM labels JOIN p USING (doc_id)""",
)
def e_eval_quality(t: Tables) -> DataFrame:
    pred = F.when((F.col("n_chars") >= 200) & F.col("lang").isin("en", "fr", "de", "es"), 1).otherwise(0)
    rows = t.labels.join(t.documents.select("doc_id", pred.alias("pred")), "doc_id")
    p, q = F.col("pred"), F.col("quality")
    return rows.agg(F.count("*").alias("n"), F.round(F.avg((p == q).cast("int")), 6).alias("accuracy"), F.count_if((p == 1) & (q == 1)).alias("tp"), F.count_if((p == 1) & (q == 0)).alias("fp"), F.count_if((p == 0) & (q == 1)).alias("fn"))
