"""Evidence packs: several small answers for one filter state, kept by a digest of what was asked."""

from __future__ import annotations

import hashlib
import json
import weakref
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import predicates as P
from ..operators import vectors as V
from ..sources.tables import stored
from .registry import Tables, query

# What a filter state may hold, and the columns of orders that stand for it.
STATE = {"year_min": 1990, "year_max": 2025}
COLUMNS = {"year": "yr", "status": "o_orderstatus", "priority": "o_orderpriority", "least_price": "o_totalprice"}
MOST = 50  # rows of a section: it is a report, meant to be read


@dataclass
class Pack:
    key: str
    sections: dict[str, DataFrame]
    limitations: list[str] = field(default_factory=list)


_packs: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()  # by session, then by key


def key_of(question: str, state: dict) -> str:
    return hashlib.md5((question + json.dumps(state, sort_keys=True, default=str)).encode()).hexdigest()


def pack(t: Tables, question: str, state: dict | None = None) -> Pack:
    """Sections as lazy DataFrames over the papers that the state selects; a pack asked for again in a session is the same one."""
    state = {**STATE, **(state or {})}
    key = key_of(question + t.folder, state)
    held = _packs.setdefault(t.spark, {})
    if key in held:
        return held[key]
    bridges = {
        "topics": (t.lineitem.join(t.part.select("p_partkey", "p_type"), F.col("p_partkey") == F.col("l_partkey")).select("l_orderkey", "p_type"), "l_orderkey", "p_type"),
        "institutions": (t.orders.select("o_orderkey", "o_custkey").join(t.customer, F.col("c_custkey") == F.col("o_custkey")).join(t.nation, F.col("n_nationkey") == F.col("c_nationkey")).select("o_orderkey", "n_name"), "o_orderkey", "n_name"),
        "authors": (t.orders.select("o_orderkey", "o_custkey"), "o_orderkey", "o_custkey"),
    }
    papers = P.selected(t.orders.withColumn("yr", F.date_format("o_orderdate", "yyyy")), state, COLUMNS, bridges, "o_orderkey")
    # what the state selects is worked out once, for all sections
    papers = stored(papers.select("o_orderkey", "o_custkey", "yr"), "papers")
    facts = t.lineitem.join(papers.select("o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
    typed = facts.join(t.part.select("p_partkey", "p_type", "p_brand"), F.col("p_partkey") == F.col("l_partkey"))
    sections = {
        "metrics": facts.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.round(F.avg("l_discount"), 4).alias("mean"), F.round(F.stddev("l_discount"), 4).alias("std")).filter("n >= 3"),
        "topics": typed.groupBy("p_type").agg(F.countDistinct("l_orderkey").alias("n")).orderBy(F.desc("n"), "p_type").limit(MOST),
        "methods": typed.groupBy("p_brand").agg(F.countDistinct("l_orderkey").alias("n")).orderBy(F.desc("n"), "p_brand").limit(MOST),
        "years": papers.groupBy("yr").agg(F.count("*").alias("n")),
        "influence": papers.groupBy("o_custkey").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "o_custkey").limit(MOST),
        "semantic": V.nearest(t.embeddings, t.embeddings.filter("vec_id = 0"), 12).select("id", "rank", F.round("similarity", 6).alias("similarity")),
    }
    limitations = ["Averages count a paper once for each of its facts.", "Similarities are those of the stored vectors; no question is encoded."]
    held[key] = Pack(key, sections, limitations)
    return held[key]


_SELECTED = "SELECT * FROM orders WHERE year(o_orderdate) BETWEEN 1990 AND 2025 AND o_orderstatus IN ('F')"


_SECTIONS = """WITH p AS (SELECTED), f AS (SELECT * FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM p)), q AS (SELECT * FROM f JOIN part ON p_partkey = l_partkey),
        v AS (SELECT a.vec_id AS query, b.vec_id AS id, list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) / sqrt(list_dot_product(a.embedding::DOUBLE[], a.embedding::DOUBLE[]) * list_dot_product(b.embedding::DOUBLE[], b.embedding::DOUBLE[])) AS s FROM embeddings a JOIN embeddings b ON a.vec_id = 0 AND b.vec_id <> 0)
        SELECT 'metrics' AS section, l_returnflag AS key, round(avg(l_discount), 4)::DOUBLE AS value FROM f GROUP BY 2 HAVING count(*) >= 3 UNION ALL (SELECT 'topics', p_type, count(DISTINCT l_orderkey)::DOUBLE FROM q GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 50)
        UNION ALL (SELECT 'methods', p_brand, count(DISTINCT l_orderkey)::DOUBLE FROM q GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 50) UNION ALL SELECT 'years', strftime(o_orderdate, '%Y'), count(*)::DOUBLE FROM p GROUP BY 2
        UNION ALL (SELECT 'influence', o_custkey::VARCHAR, count(*)::DOUBLE FROM p GROUP BY o_custkey ORDER BY 3 DESC, o_custkey LIMIT 50) UNION ALL (SELECT 'semantic', id::VARCHAR, round(s, 6) FROM v ORDER BY round(s, 9) DESC, id LIMIT 12)"""


@query(
    "EP1 T7",
    _SECTIONS.replace("SELECTED", _SELECTED),
)
def ep_evidence_pack(t: Tables) -> DataFrame:
    """The contents of all sections: what each row is about and its figure."""
    return _contents(pack(t, "what is known", {"status": ["F"]}))


def _contents(found: Pack) -> DataFrame:
    out = None
    for name, df in found.sections.items():
        key, value = ("id", "similarity") if name == "semantic" else (df.columns[0], "mean" if name == "metrics" else "n")
        part = df.select(F.lit(name).alias("section"), F.col(key).cast("string").alias("key"), F.col(value).cast("double").alias("value"))
        out = part if out is None else out.unionByName(part)
    return out


_TOPICS, _PLACES = ("ECONOMY", "SMALL"), ("NATION_1", "NATION_7", "NATION_12")


@query(
    "EP1 F7",
    _SECTIONS.replace("SELECTED", f"""{_SELECTED} AND o_orderkey IN (SELECT l_orderkey FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_type IN {_TOPICS})
        AND o_custkey IN (SELECT c_custkey FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE n_name IN {_PLACES})"""),
)
def ep_filtered_pack(t: Tables) -> DataFrame:
    """A pack under a state whose topics and institutions are semi-joins on bridge tables, below all sections."""
    return _contents(pack(t, "what is known there", {"status": ["F"], "topics": list(_TOPICS), "institutions": list(_PLACES)}))
