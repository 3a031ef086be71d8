"""Methods in use and the chain of entities on small tables: nulls, repeated rows, ties, empty tables, long texts, and a plain version of the best context."""

import random
import re

from pyspark.sql import functions as F

from marlstone.operators import entity_chain as EC
from marlstone.operators import methods as ME

REGISTRY = "name string, category string, subcategory string, dimension string, tasks array<string>, partners array<string>, components array<string>"
ENTITY = "doc string, name string, canonical string, pattern double, embedding double, llm double"
SENSE = "name string, sense string, ord int, signals array<string>, excludes array<string>, fallback boolean"


def test_methods_in_use_and_what_they_imply(spark):
    texts = spark.createDataFrame([
        ("a", "We used HEC-HMS, chained  with LISFLOOD. " + "word " * 60 + "As previous studies of SWAT say."), ("b", "HEC-HMS is named. " + "word " * 60 + "Then hec hms was applied."), ("c", None), ("d", ""), ("e", "A slope map and NDVI were used."), ("f", "An LSTM after a DWT is used."),
    ], "text_id string, text string")
    phrases = spark.createDataFrame([("HEC HMS", "HEC-HMS"), ("LISFLOOD", "LISFLOOD"), ("SWAT", "SWAT"), ("slope", "Slope"), ("ndvi", "NDVI"), ("LSTM", "LSTM"), ("DWT", "DWT")], "phrase string, name string")
    registry = spark.createDataFrame([("HEC-HMS", "physical_based", "hydrological", "1D", ["flood_forecasting"], ["LISFLOOD", "LISFLOOD", "none"], None), ("LISFLOOD", None, "hydrodynamic", "2D", None, None, None), ("LSTM", "hybrid", "s", None, None, None, None)], REGISTRY)
    found = ME.used_methods(texts, phrases, around=100)
    got = {(r.text_id, r.name): r for r in found.collect()}
    assert set(got) == {("a", "HEC-HMS"), ("a", "LISFLOOD"), ("b", "HEC-HMS"), ("e", "Slope"), ("e", "NDVI"), ("f", "LSTM"), ("f", "DWT")}
    assert got["b", "HEC-HMS"].at > 300 and "applied" in got["b", "HEC-HMS"].evidence and "  " not in got["a", "HEC-HMS"].evidence
    work = {r.text_id: r.pipelines for r in ME.implied_work(found, registry).collect()}
    assert work == {"a": ["flood_forecasting_pipeline", "flood_modeling_pipeline"], "b": ["flood_forecasting_pipeline", "flood_modeling_pipeline"], "e": ["drought_vegetation_pipeline", "terrain_analysis_pipeline"], "f": ["ml_prediction_pipeline"]}
    assert [tuple(r) for r in ME.known_couplings(texts, found, registry).collect()] == [("a", "HEC-HMS", "LISFLOOD", "hydrological_hydrodynamic")]
    both = sorted(tuple(r) for r in ME.hybrids(found, registry).collect())
    assert both == [("f", "LSTM", "s", [], "registry"), ("f", "wavelet_ml_hybrid_inferred", "wavelet_ml", ["DWT", "LSTM"], "inferred")]
    none = found.limit(0)
    assert ME.implied_work(none, registry).count() == ME.known_couplings(texts, none, registry).count() == ME.hybrids(none, registry).count() == 0


def plain_context(name, text, around, most):
    best = (0, "")
    for k, m in enumerate(list(re.finditer(re.escape(name), text, re.I | re.A))[:most]):
        s = re.sub(r"[ \t\n\r\f\v]+", " ", text[max(0, m.start() - around):m.end() + around]).strip(" ")
        n = sum(c in s.lower() for c in EC.CONTEXT_CUES)
        best = (n, s) if k == 0 or n > best[0] else best
    return best[1]


def test_best_context_by_brute_force(spark):
    rng = random.Random(3)
    words = ["SCS", "scs", "Study area", "ground truth", "tested on", "é", "a.b", "\\E", "x\ny", "aaaa", "𝄞 sign"]
    rows = [(k, rng.choice(["SCS", "a.b", "\\E", "aa", "é", "missing", "𝄞"]), " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 5, 60, 400])))) for k in range(120)]
    rows.append((900, "SCS", "word " * 300_000 + "SCS in a study area"))
    df = spark.createDataFrame(rows, "k int, name string, text string").repartition(4)
    got = {r.k: r.c for r in df.select("k", EC.context_of(F.col("text"), F.col("name"), around=40).alias("c")).collect()}
    assert got == {k: plain_context(n, t, 40, EC.PLACES) for k, n, t in rows}


def test_chain(spark):
    documents = spark.createDataFrame([
        ("p", "On SCS numbers", {"abstract": "The SCS curve number was applied in the basin.", "methods": "LSTM and lstm2 analysis", "none": None}), ("q", None, None), ("r", "", {"other": "an SCS convention"}),
    ], "doc string, title string, sections map<string,string>")
    rows = [
        ("p", " SCS ", "x", 0.9, 0.5, None), ("p", "SCS", "x", 0.9, 0.5, None), ("p", "LSTM", "Method.L", 0.9, 0.0, 1.0), ("p", "lstm2", "method.l", 0.1, None, None), ("p", "Data", "d", 1.0, 1.0, 1.0), ("p", "q", "d", 1.0, 1.0, 1.0), ("p", None, "d", 1.0, 1.0, 1.0),
        ("p", "nowhere", None, 0.5, None, None), ("p", "nowhere", "", 0.5, None, None), ("q", "SCS", "s", None, None, None), ("r", "SCS", "s", 1.0, 1.0, None), ("gone", "SCS", "s", 1.0, 1.0, 1.0),
    ]
    senses = spark.createDataFrame([("SCS", "curve", 0, ["curve number"], ["convention"], False)], SENSE)
    got = EC.chained(spark.createDataFrame(rows, ENTITY).withColumns({"_boost": F.lit(7), "_text": F.lit("x")}), documents, senses).collect()
    of = {(r.doc, r.name, r.canonical): r for r in got}
    assert len(got) == 7 and set(of) == {("p", "SCS", "curve"), ("p", "LSTM", "Method.L"), ("p", "nowhere", None), ("p", "nowhere", ""), ("q", "SCS", "s"), ("r", "SCS", "s"), ("gone", "SCS", "s")}
    first = of["p", "SCS", "curve"]
    assert (first.role, first.context_score, first.score, first.accepted) == ("used", 0.8, 1.0, True) and first.alt_evidence == first.evidence
    # 0.3 * 0.9 + 0.3 * 0.8 + 0.2 and the methods
    assert (of["p", "LSTM", "Method.L"].score, of["p", "LSTM", "Method.L"].alt_evidence.startswith("The SCS")) == (0.96, True)
    assert (of["p", "nowhere", None].evidence, of["p", "nowhere", None].role, of["p", "nowhere", None].accepted) == ("", "mentioned", False)
    assert (of["r", "SCS", "s"].score, of["gone", "SCS", "s"].score, of["q", "SCS", "s"].score) == (0.5, 0.7, 0.0)
    assert EC.chained(spark.createDataFrame([], ENTITY), documents, senses).count() == 0
