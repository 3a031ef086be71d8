"""Merged registries, their statistics, routes of parsers and conformance of tables on small cases: nulls, ties, repeated rows, cycles, empty tables."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.operators import registry_merge as RM
from marlstone.operators import routing as RO

SOURCE = "ord int, id string, type string, definition string, domain string, source string, aliases array<string>, inputs array<string>"
ENTITY = "id string, type string, type_group string, definition string, aliases array<string>, sources array<string>, parent_id string, is_generic boolean"


def test_sources_are_merged_by_id(spark):
    rows = [
        (3, "method.a", "model", "four", "late", "f2", ["B ", "c", None], None), (1, "method.a", "metric", "five5", "", "f1", ["b", "A", "a"], ["x"]), (2, "method.a", "method", "abcde", "first", "f1", None, ["X", " y"]),
        (4, "org.a", "x", None, None, None, [], []), (5, "odd", "thing", "", "d", "f3", ["b"], None), (6, None, "method", "d", "d", "f", ["z"], ["z"]),
    ]
    patched = spark.createDataFrame([(2, "method.a", "B"), (1, "method.a", "b"), (3, "method.a", "new"), (4, "method.a", "new"), (5, "gone.x", "n"), (6, "odd", None)], "ord int, id string, alias string")
    sources = spark.createDataFrame(rows, SOURCE)
    got = {r.id: r for r in RM.merged_sources(sources, ("aliases", "inputs"), patched).collect()}
    assert set(got) == {"method.a", "org.a", "odd"}
    a = got["method.a"]
    assert (a.type, a.definition, a.domain, a.sources, a.aliases, a.inputs, a.file) == ("method", "five5", "first", ["f1", "f2"], ["b", "A", "c", "B", "new"], ["x", " y"], "methods")
    assert (got["org.a"].type, got["org.a"].definition, got["org.a"].domain, got["org.a"].sources, got["org.a"].aliases, got["org.a"].file) == ("organization", "", None, [], [], "concepts")
    assert (got["odd"].type, got["odd"].aliases, got["odd"].file) == ("thing", ["b"], "concepts")
    assert RM.merged_sources(sources.limit(0), ("aliases", "inputs")).count() == 0
    assert RM.merged_sources(sources, ("aliases",)).filter("id = 'method.a'").first().aliases == ["b", "A", "c"]


def test_statistics(spark):
    rows = [("a", "m", "g", "d", ["x", "y"], ["s", "s"], None, True), ("b", None, "", " ", [], None, "a", None), ("c", "m", None, None, None, ["t", None], "b", False), ("d", "m", "g", "d", ["x"], [], "none", False), ("e", "n", "g", "d", ["x"], ["s"], "f", False), ("f", "n", "g", "d", ["x"], ["s"], "e", False)]
    df = spark.createDataFrame(rows, ENTITY)
    got = {(r.what, r.key): r.value for r in RM.statistics(df).collect()}
    want = {
        ("entities", "count"): 6, ("entities", "generic"): 1, ("definition", "with"): 4, ("definition", "without"): 2, ("definition", "percent"): 66.7, ("aliases", "min"): 0, ("aliases", "max"): 2, ("aliases", "mean"): 0.83, ("aliases", "median"): 1, ("aliases", "none"): 2,
        ("aliases", "all"): 5, ("type", "m"): 3, ("type", "unknown"): 1, ("type", "n"): 2, ("type_group", "g"): 4, ("type_group", "unassigned"): 2, ("grouped", "m"): 66.7, ("grouped", "unknown"): 0, ("grouped", "n"): 100, ("source", "s"): 4, ("source", "t"): 1,
        ("hierarchy", "roots"): 1, ("hierarchy", "children"): 5, ("hierarchy", "deepest"): 2, ("hierarchy", "parents"): 5,
    }
    assert got == want
    empty = {(r.what, r.key): r.value for r in RM.statistics(df.limit(0)).collect()}
    assert empty["entities", "count"] == empty["aliases", "median"] == empty["definition", "percent"] == empty["hierarchy", "roots"] == 0 and ("type", "m") not in empty


def test_quality_and_routes(spark):
    shape = "doc int, title string, abstract string, sections int, all_sections int, references int, citations int, boxes int, formulas int, tables int, figures int, has_second boolean"
    rows = [(0, "t", "a", 1, 3, 1, 1, 1, 1, 0, 2, True), (1, None, "", 1, 1, None, None, None, None, None, None, None), (2, "t", "a", 0, 5, 1, 1, 1, 0, 1, 1, False), (3, "t", None, 1, 2, 0, 0, 0, 0, 0, 0, False)]
    got = {r.doc: r for r in RO.document_quality(spark.createDataFrame(rows, shape)).collect()}
    assert [(got[k].quality_score, got[k].usable, got[k].needs_second) for k in range(4)] == [(1.0, True, False), (0.2, True, True), (0.8, False, False), (0.35, True, True)]
    assert sum(RO.WEIGHTS.values()) == pytest.approx(1.0) and got[0].has_ocr_text and got[0].has_figures and not got[0].has_tables and not got[1].has_ocr_text
    docs = spark.createDataFrame([(0, True, False, True, True), (1, True, True, True, True), (2, True, False, False, True), (3, True, None, None, False), (4, None, None, None, None)], "doc int, parsed boolean, scanned boolean, has_text boolean, usable boolean")
    routes = lambda *a: [r.route for r in RO.routed(docs, *a).orderBy("doc").collect()]
    assert routes("nougat_only") == ["second"] * 5 and routes("hybrid") == ["both"] * 5 and routes("grobid_only") == ["first"] * 4 + ["none"]
    assert routes("auto", False) == ["first", "second", "second", "both", "both"] and routes("grobid_with_nougat_fallback", False) == ["first", "first", "first", "both", "both"]
    assert routes("grobid_with_nougat_fallback") == ["both"] * 5 and routes(F.lit("other")) == [None] * 5
    with pytest.raises(ValueError):
        RO.routed(docs, "other")


def test_conformance(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "id int, x string")
    shape = lambda s: T.StructType.fromDDL(s)
    got = RO.conformance({"a": df, "b": df.limit(0), "c": None, "_0": df}, {"a": df.schema, "b": df.schema, "c": df.schema, "d": df.schema, "_0": shape("id long, y string")}, {"a": ["id", "x", "gone"], "b": ["id"], "_0": ["id"]}, ["a", "b"])
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted([
        ("a", "ok", "rows", None, 2), ("a", "warning", "null ids", "id", 1), ("a", "warning", "null ids", "x", 2), ("b", "ok", "rows", None, 0), ("b", "warning", "empty", None, 0), ("c", "error", "absent", None, None), ("d", "error", "absent", None, None),
        ("_0", "error", "missing column", "y", None), ("_0", "error", "unexpected column", "x", None), ("_0", "error", "type int for bigint", "id", None), ("_0", "warning", "null ids", "id", 1),
    ], key=str)
