"""Queries on places named in texts. Texts are put together from stretches by the customer's key, the same in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import geography as G
from .phrases import phrase, phrase_sql, quoted
from .registry import Tables, query

STRETCHES = (
    "the study area lies in Ukraine", "on the Dnipro River, we model", "data of the Lower Krka floodplain", "Polish and German gauges", "Ismail et al. used the Zambezi River in a plain", "new South-Wales and Wales",
    "located in the Cagayan Valley of Luzon", "at 46°38'N, 32°36'E", "the Sava floods", "global scale maps of hundreds of scenes", "at 48.25 N, 16.5 E", "Kherson and Kyiv Oblast", "forest-steppe soils",
    "previous study of the Danube", "swales and dykes", "the Ganges, England's trade", "Rhondda Cynon Taf", "no place at all",
)
CORES = ("the Sava and its floods", "plain words", "Danube and Zambezi")
_PICKS = ((5, 1), (7, 3), (11, 2), (13, 5))
_CORE = ((1, 0),)
_TEXTS = f"t AS (SELECT c_custkey AS text_id, {phrase_sql('c_custkey', STRETCHES, _PICKS)} AS text, {phrase_sql('c_custkey', CORES, _CORE)} AS core FROM customer)"


def _texts(t: Tables) -> DataFrame:
    key = F.col("c_custkey")
    return t.customer.select(key.alias("text_id"), phrase(key, STRETCHES, _PICKS).alias("text"), phrase(key, CORES, _CORE).alias("core"))


def _phrases_sql(lists: dict[str, str], kind: str) -> str:
    return ", ".join(f"({quoted(p)}, {quoted(name)}, {quoted(kind)})" for name, listed in lists.items() for p in listed.split(", "))


_PIECE = r"[^\p{L}\p{N}]*[\p{L}\p{N}]+"


@query(
    "E15 E9",
    f"""WITH RECURSIVE {_TEXTS}, p(gram, name, kind) AS (VALUES {_phrases_sql(G.COUNTRIES, 'country')}, {_phrases_sql(G.REGIONS, 'region')}),
        w AS (SELECT text_id, regexp_extract_all(text, '{_PIECE}') AS pieces, list_transform(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}]+'), lambda x: lower(x)) AS words FROM t),
        g AS (SELECT text_id, i, n, array_to_string(words[i + 1:i + n], ' ') AS gram FROM w, range(0, 60) a(i), range(1, 4) b(n) WHERE i + n <= len(words)),
        h AS (SELECT text_id, i, n, name, kind FROM g JOIN p USING (gram)),
        k(text_id, kind, upto, i, n) AS (
            SELECT DISTINCT text_id, kind, 0, -1, 0 FROM h
            UNION ALL
            SELECT text_id, kind, b.i + b.n, b.i, b.n FROM (SELECT k.text_id, k.kind, min(row(h.i, -h.n)) AS f FROM k JOIN h ON h.text_id = k.text_id AND h.kind = k.kind AND h.i >= k.upto GROUP BY k.text_id, k.kind, k.upto) x,
                 LATERAL (SELECT f[1] AS i, -f[2] AS n) b),
        s AS (SELECT k.text_id, k.kind, h.name, list_sum(list_transform(pieces[1:k.i + 1], lambda x: len(x))) - len(words[k.i + 1]) AS start, list_sum(list_transform(pieces[1:k.i + k.n], lambda x: len(x))) AS upto
              FROM k JOIN h ON h.text_id = k.text_id AND h.kind = k.kind AND h.i = k.i AND h.n = k.n JOIN w ON w.text_id = k.text_id WHERE k.n > 0)
        SELECT text_id, kind, name, min(start)::INT AS start, arg_min(upto, start)::INT AS "end" FROM s GROUP BY 1, 2, 3""",
)
def e_places(t: Tables) -> DataFrame:
    """Countries and regions by name, with the characters of the first place in the text: the longest name counts, names don't overlap."""
    return G.places(_texts(t)).select("text_id", "kind", "name", "start", "end")


def _words(words) -> str:
    return f"len(list_filter([{', '.join(map(quoted, words))}], lambda x: contains(around, x))) > 0"


@query(
    "E34",
    rf"""WITH {_TEXTS}, l(name, country) AS (VALUES {', '.join(f"({quoted(a)}, {quoted(b)})" for a, b in G.RIVERS.items())}),
        f AS (SELECT text_id, text, core, unnest(regexp_extract_all(text, '{G._NAMED}', 1)) AS raw, unnest(regexp_extract_all(text, '{G._NAMED}', 0)) AS whole FROM t
              UNION ALL SELECT text_id, text, core, unnest(regexp_extract_all(text, '{G._KNOWN}')), unnest(regexp_extract_all(text, '{G._KNOWN}')) FROM t),
        n AS (SELECT text_id, text, core, regexp_replace(raw, '^([Tt]he|[Aa]n?)\s+', '') AS name, whole, strpos(text, whole) - 1 AS start FROM f),
        c AS (SELECT text_id, name, arg_min(row(start, lower(substr(text, greatest(start - {G.AROUND}, 0) + 1, start + len(whole) + {G.AROUND} - greatest(start - {G.AROUND}, 0))), core), row(start, len(whole))) AS b FROM n GROUP BY 1, 2),
        d AS (SELECT text_id, name, b[1]::INT AS start, b[2] AS around, contains(lower(b[3]), lower(name)) AS told FROM c),
        e AS (SELECT text_id, name, start, CASE WHEN {_words(G.CITED)} THEN 0.0 WHEN {_words(G.STUDIED)} THEN 0.9 WHEN told THEN 0.5 ELSE 0.0 END::DOUBLE AS score,
                     CASE WHEN {_words(G.CITED)} THEN 'citation' WHEN {_words(G.STUDIED)} THEN 'study_area' ELSE 'unknown' END AS source FROM d)
        SELECT text_id, e.name, start, score, score > 0.4 AS accepted, source, CASE WHEN score > 0.4 THEN country END AS country FROM e LEFT JOIN l ON l.name = e.name""",
)
def e_rivers(t: Tables) -> DataFrame:
    """Rivers named in a text, judged by what is said around the first place that names them."""
    return G.rivers(_texts(t))


@query("E15")
def e_geography(t: Tables) -> DataFrame:
    """One row a text: the study's country, countries, regions, accepted rivers, coordinates, scope and confidence."""
    return G.geography(_texts(t))
