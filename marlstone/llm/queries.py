"""The queries of this package, over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def _lloyd_sql(k: int = 16, rounds: int = 3) -> str:
    """Lloyd's rounds over embeddings, one pair of subqueries for each."""
    near = """SELECT vec_id, v, r.cluster, r.distance FROM (
        SELECT vec_id, v, unnest(min_by(struct_pack(cluster := c, distance := d), d * 1000 + c, 1)) AS r FROM (
            SELECT p.n, p.vec_id, p.v, t.c, list_sum(list_transform(list_zip(p.v, t.m), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM p, {t} t) GROUP BY n, vec_id, v)"""
    parts = [
        f"""p AS (SELECT vec_id, row_number() OVER () AS n, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
             WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"t0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id::VARCHAR)) - 1 AS c, v AS m FROM p QUALIFY c < {k})",
    ]
    for i in range(rounds):
        parts.append(f"a{i} AS ({near.format(t=f't{i}')})")
        parts.append(f"""s{i} AS (SELECT c, list(q ORDER BY i) AS m FROM (SELECT c, i, ((s - ((s % n) + n) % n) / n)::BIGINT AS q FROM (
            SELECT cluster AS c, i, sum(v[i])::HUGEINT AS s, count(*) AS n FROM a{i}, range(1, 65) x(i) GROUP BY 1, 2)) GROUP BY c)""")
        parts.append(f"t{i + 1} AS (SELECT t.c, coalesce(s.m, t.m) AS m FROM t{i} t LEFT JOIN s{i} s USING (c))")
    parts.append(f"a AS ({near.format(t=f't{rounds}')})")
    return f"""WITH {", ".join(parts)}
        SELECT vec_id, cluster::INTEGER AS cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia,
               sha256(array_to_string(m, ',')) AS centroid_sha256
        FROM a JOIN t{rounds} ON c = cluster"""


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .exact_dedup import decisions

    return decisions(_read(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_counts import count

    return count(_read(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secret_scan import scan

    return scan(_read(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(_read(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language_id import fit, identify

    docs = _read(spark, sf_dir, "documents")
    return identify(docs, fit(docs))


def pages_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op5's operator over web pages: markup, address suffix and host priors speak, by tables learned from documents."""
    from .language_id import fit, of_pages

    return of_pages(_read(spark, sf_dir, "pages"), fit(_read(spark, sf_dir, "documents")))


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lm_score import score

    return score(_read(spark, sf_dir, "documents"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .near_dedup import classes

    return classes(_read(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import judge

    return judge(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark")).drop("stretches")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import scan

    return scan(_read(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_filter import judge

    return judge(_read(spark, sf_dir, "pages"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .filter_audit import audit

    return audit(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op12_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .curriculum import by_position, mixed

    return by_position(mixed(_read(spark, sf_dir, "documents")))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .centroids import clusters

    return clusters(_read(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return import_module("corpus_pipeline").run(spark, sf_dir)


QUERIES: dict[str, Query] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_token_counts": op2_token_counts,
    "op3_secret_scan": op3_secret_scan,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_language_id": op5_language_id,
    "op6_lm_score": op6_lm_score,
    "op7_near_dedup": op7_near_dedup,
    "op8_decontamination": op8_decontamination,
    "op9_pii": op9_pii,
    "op10_url_filter": op10_url_filter,
    "op11_filter_audit": op11_filter_audit,
    "op12_source_mix": op12_source_mix,
    "op13_centroids": op13_centroids,
    "pipeline": pipeline,
    "pages_language_id": pages_language_id,
}

ORACLES: dict[str, str] = {
    "op1_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op8_decontamination": r"""
        WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^0-9a-z\x{80}-\x{10FFFF}]+'), lambda x: x <> '') AS w FROM documents),
        b AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^0-9a-z\x{80}-\x{10FFFF}]+'), lambda x: x <> '') AS w FROM benchmark),
        bi AS (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0),
        bw AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g FROM bi),
        di AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n),
        h AS (SELECT doc_id, i, di.n, item_id FROM di JOIN bw ON bw.n = di.n AND bw.g = array_to_string(list_slice(w, i, i + di.n - 1), ' ')),
        hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM h) GROUP BY 1),
        it AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM h GROUP BY 1)
        SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN it ON it.doc_id = d.doc_id
    """,
    "op11_filter_audit": r"""
        WITH d AS (SELECT coalesce(source, '') AS part, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                          min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least FROM documents),
        m AS (SELECT part, doc_id,
                     (len(w) < 50)::INT + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::INT + 4 * (100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t))::INT
                     + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(doc_id > least, false)::INT AS mask FROM d),
        l AS (SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS toxic FROM labels GROUP BY 1),
        k AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM m LEFT JOIN l USING (doc_id) GROUP BY 1, 2),
        f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
        o AS (SELECT [a.f, b.f, c.f, d.f, e.f] AS o, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits FROM f a, f b, f c, f d, f e
              WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
        s AS (SELECT array_to_string(o, '') AS filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before FROM o, range(1, 6) x(step)),
        r AS (SELECT part, filter_order, step, bit, sum(n) FILTER (mask & (before | bit) = 0) AS kept, sum(n) FILTER (mask & before = 0 AND mask & bit > 0) AS removed,
                     sum(n) FILTER (mask & before > 0 AND mask & bit > 0) AS redundant, sum(n) FILTER (mask = bit) AS unique_fails,
                     sum(good) FILTER (mask & before = 0 AND mask & bit > 0) AS good_lost, sum(toxic) FILTER (mask & before = 0 AND mask & bit > 0) AS toxic_lost FROM k, s GROUP BY 1, 2, 3, 4)
        SELECT part, filter_order, step::INTEGER AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
               coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
               (sum(coalesce(removed, 0)) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM r
    """,
    "op12_source_mix": r"""
        WITH RECURSIVE d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, md5('12:' || coalesce(doc_id::VARCHAR, '')) AS ord FROM documents),
        s AS (SELECT source, source_size, place, [5.0, 2.0, 1.0][place % 3 + 1]::DOUBLE AS weight
              FROM (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM d GROUP BY 1)),
        l(round, level) AS (
            SELECT 0, 0.0::DOUBLE
            UNION ALL SELECT round + 1, (SELECT (1.5 * sum(source_size) - coalesce(sum(2 * source_size) FILTER (2 * source_size < level * weight), 0))::DOUBLE
                                                 / (sum(weight) FILTER (2 * source_size >= level * weight)) FROM s) FROM l WHERE round < 50),
        t AS (SELECT s.*, least(2.0 * source_size, weight * (SELECT max(level) FROM l))::DOUBLE AS target FROM s),
        p AS (SELECT doc_id, size, source_size, target, place, sum(size) OVER (PARTITION BY d.source ORDER BY ord, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS start
              FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
        q AS (SELECT *, greatest(0, least(size, floor(target)::BIGINT - start)) + greatest(0, least(size, floor(target)::BIGINT - start - source_size)) AS taken,
                     (start / target)::DOUBLE AS asked, [1.5, 1.0, 0.5][place % 3 + 1]::DOUBLE AS a, [-1.0, 0.0, 1.0][place % 3 + 1]::DOUBLE AS slope FROM p)
        SELECT doc_id, size, source_size, target, taken::BIGINT AS taken, CASE WHEN taken > 0 THEN 0.0 + 2 * asked / (a + sqrt(a * a + 2 * slope * asked)) END AS position FROM q
    """,
    "op13_centroids": _lloyd_sql(),
}
