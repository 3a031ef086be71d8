"""Queries on checks of values, coordinates and mentions, and on repairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import checks as C
from .phrases import phrase, phrase_sql, quoted
from .registry import Tables, query

_FORMS_SQL = "[printf('%.4f', v), printf('%.3f', v), printf('%.2f', v), printf('%.2f', v * 100), printf('%.1f', v * 100), printf('%.0f', v * 100)]"


@query(
    "E8",
    f"""WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_discount AS v, CASE l_orderkey % 4 WHEN 0 THEN 'share of ' || l_discount WHEN 1 THEN 'about ' || round(l_discount * 100)::INT || '%' WHEN 2 THEN 'some 1' || l_discount || '7' ELSE 'none told' END AS text FROM lineitem),
        f AS (SELECT *, list_filter(list_transform({_FORMS_SQL}, lambda x: regexp_replace(regexp_replace(x, '0+$', ''), '\\.$', '')), lambda x: x <> '') AS f FROM r)
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, len(list_filter(f, lambda x: regexp_matches(text, '(^|[^0-9])' || replace(x, '.', '\\.') || '([^0-9]|$)'))) > 0 AS literal FROM f""",
)
def e_literal_check(t: Tables) -> DataFrame:
    """Whether a value stands in the text it is said to come from."""
    k, v = F.col("l_orderkey") % 4, F.col("l_discount")
    text = F.when(k == 0, F.concat(F.lit("share of "), v.cast("string"))).when(k == 1, F.concat(F.lit("about "), F.round(v * 100).cast("int").cast("string"), F.lit("%"))).when(k == 2, F.concat(F.lit("some 1"), v.cast("string"), F.lit("7"))).otherwise("none told")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", C.literal_in(v, text).alias("literal"))


@query(
    "E23",
    """WITH b AS (SELECT p_partkey AS element, CASE WHEN p_partkey % 7 = 0 THEN '' ELSE p_name END AS text, p_size % 6 AS page, p_size - 3.0 AS x, p_retailprice - 950 AS w FROM part WHERE p_partkey % 5 <> 0),
       e AS (SELECT element, text, unnest([page, page + (element % 2)]) AS page, unnest([x, 1.0]) AS x, 2.0 AS y, unnest([w, 5.0]) AS w, 4.0 AS h FROM b)
       SELECT element, 'NEGATIVE_PAGE' AS code, 'page=' || page AS detail FROM e WHERE page < 1 UNION ALL SELECT element, 'ZERO_DIMENSION', 'w=' || printf('%.1f', w) || ' h=4.0' FROM e WHERE w <= 0 UNION ALL SELECT element, 'ZERO_POSITION', 'x=' || printf('%.1f', x) || ' y=2.0' FROM e WHERE x < 0
       UNION ALL SELECT element, 'MULTI_PAGE_SPAN', page || ',' || (page + 1) FROM b WHERE element % 2 = 1 UNION ALL SELECT element, 'EMPTY_TEXT_COORDS', '' FROM b WHERE text = ''""",
)
def e_box_issues(t: Tables) -> DataFrame:
    """Issues of elements' boxes by five codes."""
    key, page = F.col("p_partkey"), F.col("p_size") % 6
    box = lambda p, x, w: F.struct(p.cast("int").alias("page"), x.cast("double").alias("x"), F.lit(2.0).alias("y"), w.cast("double").alias("w"), F.lit(4.0).alias("h"))
    boxes = F.when(key % 5 != 0, F.array(box(page, F.col("p_size") - 3.0, F.col("p_retailprice") - 950), box(page + key % 2, F.lit(1.0), F.lit(5.0))))
    return C.box_issues(t.part.select(key.alias("element"), F.when(key % 7 == 0, "").otherwise(F.col("p_name")).alias("text"), boxes.alias("boxes")))


NAMES = ("SWAT", "LSTM", "NDVI")
TALK = ("we applied SWAT to it", "previous studies of LSTM", "NDVI data were obtained", "a swatch of cloth", "lstm", "SWAT, see the review of them", "for the whole of the long year that went by without a word of it", "rivers and fields", "California", "canopy of trees")
_TALK_PICKS = ((3, 1), (7, 2), (1, 5))
_HITS = f"""t AS (SELECT o_orderkey AS text_id, {phrase_sql('o_orderkey', TALK, _TALK_PICKS)} AS text FROM orders), n AS (SELECT unnest([{', '.join(map(quoted, NAMES))}]) AS name),
    p AS (SELECT text_id, text, name, unnest(range(1, length(text) - length(name) + 2)) AS i FROM t, n WHERE contains(lower(text), lower(name))),
    h AS (SELECT text_id, text, name, i - 1 AS at_ FROM p WHERE lower(substr(text, i, length(name))) = lower(name) AND NOT regexp_matches(CASE WHEN i = 1 THEN ' ' ELSE substr(text, i - 1, 1) END, '[A-Za-z0-9\\-]') AND NOT regexp_matches(substr(text || ' ', i + length(name), 1), '[A-Za-z0-9\\-]'))"""


def _context(around: int) -> str:
    return f"substr(text, greatest(at_ - {around}, 0) + 1, at_ + length(name) + {around} - greatest(at_ - {around}, 0))"


def talk(t: Tables) -> DataFrame:
    return t.orders.select(F.col("o_orderkey").alias("text_id"), phrase(F.col("o_orderkey"), TALK, _TALK_PICKS).alias("text"))


def names(t: Tables) -> DataFrame:
    return t.spark.createDataFrame([(n,) for n in NAMES], "name string")


def _cue(words) -> str:
    return f"len(list_filter([{', '.join(map(quoted, words))}], lambda x_: contains(lower(context), x_)))"


@query(
    "E33 E9",
    f"""WITH {_HITS}, c AS (SELECT text_id, name, at_, {_context(25)} AS context FROM h), u AS (SELECT * FROM c WHERE {_cue(C.USED)} > 0 AND {_cue(C.SPOKEN_OF)} = 0) SELECT text_id, name, min(at_)::INT AS at, arg_min(context, at_) AS context FROM u GROUP BY 1, 2""",
)
def e_real_usage(t: Tables) -> DataFrame:
    """Names that a text uses, not only speaks of, with the stretch that says so."""
    return C.really_used(C.mentions(talk(t), names(t), 25))


_SENSES = (("SWAT", "model", 0, ("applied", "obtained"), ("review",), False), ("SWAT", "team", 1, ("cloth", "review", "rivers"), ("applied",), True), ("LSTM", "network", 0, ("fields",), (), True), ("LSTM", "other", 1, ("previous", "trees"), ("fields",), False))


def _senses_sql() -> str:
    arr = lambda xs: "[" + ", ".join(map(quoted, xs)) + "]::VARCHAR[]"
    return "(VALUES " + ", ".join(f"({quoted(n)}, {quoted(s)}, {o}, {arr(a)}, {arr(b)}, {str(f).lower()})" for n, s, o, a, b, f in _SENSES) + ") s(name, sense, ord, signals, excludes, fallback)"


@query(
    "E14 O6 X7",
    f"""WITH {_HITS}, c AS (SELECT text_id, name, at_, {_context(40)} AS context, row_number() OVER (PARTITION BY text_id, name ORDER BY at_) AS k FROM h), b AS (SELECT text_id, name, first(context ORDER BY {_cue(('applied', 'review', 'obtained'))} DESC, at_) AS context FROM c WHERE k <= 10 GROUP BY 1, 2),
        g AS (SELECT text_id, b.name, sense, ord, fallback, greatest(0, len(list_filter(signals, lambda x_: contains(lower(context), x_))) - len(list_filter(excludes, lambda x_: contains(lower(context), x_)))) AS hits FROM b JOIN {_senses_sql()} ON s.name = b.name)
        SELECT text_id, name, CASE WHEN max(hits) > 0 THEN first(sense ORDER BY hits DESC, ord) ELSE max(sense) FILTER (WHERE fallback) END AS sense, max(hits)::INT AS hits FROM g GROUP BY 1, 2""",
)
def e_acronym_senses(t: Tables) -> DataFrame:
    """The sense of an acronym by the words around its best mention."""
    senses = t.spark.createDataFrame(list(_SENSES), "name string, sense string, ord int, signals array<string>, excludes array<string>, fallback boolean")
    return C.sense_of(C.best_contexts(C.mentions(talk(t), names(t), 40), ("applied", "review", "obtained")), senses)


REPORTED = ("overall accuracy of", "kappa", "F1-score", "was 12%", "omission error", "it ended.", "user's accuracy", "IoU", "of the map", "and then", "OA")
_REPORTED_PICKS = ((3, 1), (5, 2), (7, 3))
_RULE_SQL = " ".join(
    f"WHEN regexp_matches(b, {quoted('(?i)' + kw)}) AND NOT coalesce(regexp_matches(regexp_extract(b, {quoted('(?is)^(.*)(' + kw + ')(.*)$')}, 1), '(?s)^.+?' || {quoted(C.PERCENT)}) AND NOT regexp_matches(regexp_extract(b, {quoted('(?is)^(.*)(' + kw + ')(.*)$')}, 1), '^' || {quoted(C.PERCENT)}), false) AND NOT regexp_matches(regexp_extract(b, {quoted('(?is)^(.*)(' + kw + ')(.*)$')}, 3), {quoted(C.PERCENT)})"
    + (f" AND NOT (regexp_matches(regexp_extract(b, {quoted('(?is)^(.*)(' + kw + ')(.*)$')}, 1), {quoted('(?i)' + ex)}) AND NOT contains(regexp_extract(regexp_extract(b, {quoted('(?is)^(.*)(' + kw + ')(.*)$')}, 1), {quoted('(?is)^.*?(?:' + ex + ')(.*)$')}, 1), '.'))" if ex else "")
    + f" THEN {quoted(kind)}"
    for kind, _, kw, ex in C.PERCENT_RULES
)


@query(
    "E40",
    f"""WITH s AS (SELECT event_id, {phrase_sql('event_id', REPORTED, _REPORTED_PICKS)} || ' ' || (event_id % 90 + 3) || '% in all' AS snippet, event_id % 90 + 3 AS pct FROM events), i AS (SELECT *, length(regexp_extract(snippet, '(?s)^(.*?)\\b' || pct || '\\s*%', 1)) AS i FROM s),
        w AS (SELECT event_id, substr(snippet, greatest(i - 80, 0) + 1, least(i, 80)) AS b FROM i) SELECT event_id, CASE {_RULE_SQL} END AS kind FROM w""",
)
def e_percent_repair(t: Tables) -> DataFrame:
    """What values stored as plain percentages are, by the words before them."""
    pct = F.col("event_id") % 90 + 3
    snippet = F.concat(phrase(F.col("event_id"), REPORTED, _REPORTED_PICKS), F.lit(" "), pct.cast("string"), F.lit("% in all"))
    return t.events.select("event_id", C.reclassified(snippet, pct / 100).alias("kind"))
