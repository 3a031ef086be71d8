"""Facts, registries, cascades, merged parses and mentions on small tables: nulls, repeated rows, empty tables, planted cases."""

import pytest

from marlstone.operators import cascade, factbase as FB, mentions as M, parses, predicates, registry_checks as RC

ENTITY = "id string, display_name string, type string, aliases array<string>, parent_id string, is_generic boolean"


def facts_of(spark, sources=(), methods=(), metrics=(), areas=(), tasks=(), properties=()):
    make = spark.createDataFrame
    return FB.atomic_facts(
        make(list(sources), "paper_id string, name string, sensor_type string, snippet string"), make(list(methods), "paper_id string, name string, category string, section string, snippet string"),
        make(list(metrics), "paper_id string, type string, value double, unit string, section string, snippet string"), make(list(areas), "paper_id string, country string, region string, river_basin string, snippet string"),
        make(list(tasks), "paper_id string, task string, section string, snippet string"), make(list(properties), "paper_id string, value string, snippet string"),
    )


def test_facts_link_and_tell_what_is_wrong(spark):
    got = facts_of(
        spark, [("p", "MODIS", "optical", None), ("p", "MODIS", "optical", "x" * 300), ("p", "HomeSat", None, ""), ("p", None, None, "s"), (None, "MODIS", None, "s")], [("p", "rf", None, "introduction", "s"), ("q", "rf", None, None, "s")],
        [("p", "NSE", 0.5, "-", "results", "s"), ("p", "NSE", 0.5, "-", "abstract", "s"), ("p", "RMSE", None, None, None, None)], [("p", None, "Study area.", "", "s"), ("q", "", None, None, "s")], [("p", "", None, "s")], [("p", "live", None)],
    )
    rows = {(r.paper_id, r.fact_type, r.name): r for r in got.collect()}
    assert len(rows) == 8 and set(rows) == {("p", "data_source", "MODIS"), ("p", "data_source", "HomeSat"), ("p", "method", "rf"), ("q", "method", "rf"), ("p", "result", "NSE"), ("p", "result", "RMSE"), ("p", "study_area", "Study area."), ("p", "system_property", "live")}
    ids = {k: r.fact_id for k, r in rows.items()}
    assert len(set(ids.values())) == 8
    assert rows["p", "result", "NSE"].related_fact_ids == [ids["p", "method", "rf"]] and rows["q", "method", "rf"].related_fact_ids == []
    assert set(rows["p", "method", "rf"].related_fact_ids) == {ids["p", "data_source", "MODIS"], ids["p", "data_source", "HomeSat"], ids["p", "study_area", "Study area."]}
    assert [len(e.text) for e in rows["p", "data_source", "MODIS"].evidence] == [200]
    assert rows["p", "data_source", "HomeSat"].reasons == ["no evidence", "unknown satellite without evidence"] and rows["p", "study_area", "Study area."].reasons == ["no place named"]
    assert rows["p", "method", "rf"].reasons == ["evidence outside methods"] and rows["p", "result", "NSE"].reasons == [] and rows["p", "result", "RMSE"].reasons == ["no evidence"]
    assert {(r.rel, r.src_type, r.dst_type) for r in FB.fact_edges(got).collect()} >= {("EVALUATES", "result", "method"), ("APPLIED_TO", "method", "data_source"), ("RUNS_ON", "system_property", "data_source")}
    assert facts_of(spark).count() == 0


def test_hierarchy_with_cycles_and_depth(spark):
    chain = [(f"m.n{k}", "n", "method", ["a"], f"m.n{k - 1}" if k else None, False) for k in range(40)]
    loops = [("c.a", "a", "concept", [], "c.b", None), ("c.b", "b", "concept", None, "c.c", None), ("c.c", None, None, [], "c.a", None), ("c.in", "i", "", [], "c.a", None), ("c.self", "s", "", [], "c.self", None), ("c.o", "o", "", [], "none", None)]
    got = {r.id: (r.root, r.depth, r.in_cycle) for r in RC.hierarchy(spark.createDataFrame(chain + loops, ENTITY)).collect()}
    assert all(got[f"m.n{k}"] == ("m.n0", k, False) for k in range(40))
    assert all(got[x] == (None, None, True) for x in ("c.a", "c.b", "c.c", "c.in", "c.self")) and got["c.o"] == ("c.o", 0, False)
    assert RC.hierarchy(spark.createDataFrame([], ENTITY)).count() == 0


def test_each_code_is_told(spark):
    rows = [
        ("method.a", "Alpha", "method", ["alpha", "b"], None, False), ("method.b", "alpha ", "method", ["x"], "none.such", True), ("sensor.c", " ", "metric", ["sensor.c"], None, None), ("Bad", None, None, None, None, None), ("thing.d", "D", "thing", [], "", False),
    ]
    df = spark.createDataFrame(rows, ENTITY)
    told = {(r.code, r.entity_id) for r in RC.violations(df, spark.createDataFrame([("method.a",), ("method.b",)], "id string")).collect()}
    assert told == {
        ("V01", "Bad"), ("V01", "thing.d"), ("V02", "Bad"), ("V03", "sensor.c"), ("V03", "Bad"), ("V03", "thing.d"), ("V04", "method.b"), ("V05", "sensor.c"), ("V05", "Bad"), ("V06", "method.a"), ("V06", "sensor.c"),
        ("V07", "method.a"), ("V08", "method.a"), ("V08", "method.b"),
    }
    got = {(r.code, r.slug, r.entity_id, r.n) for r in RC.collisions(df).collect()}
    assert got == {("C01", "alpha", "method.a", 2), ("C01", "alpha", "method.b", 2), ("C01", "b", "method.a", 2), ("C01", "b", "method.b", 2), ("C02", "alpha", "method.a", 2), ("C02", "alpha", "method.b", 2), ("C03", "b", "method.b", 1)}


def test_only_what_rules_leave_open_meets_vectors(spark):
    texts = spark.createDataFrame([(1, "A survey of maps", "A survey of maps"), (2, "", "We applied it"), (3, "", "words"), (4, "", "words of the literature"), (5, None, None), (6, "Review of", "a flood event occurred")], "text_id int, heading string, body string")
    vectors = spark.createDataFrame([(k, [1.0, 0.0]) for k in (1, 2, 3, 4)] + [(5, [0.0, 0.0])], "text_id int, vec array<double>")
    prototypes = spark.createDataFrame([("regional", [0.9, 0.1]), ("review", [0.0, 1.0]), ("regional", [1.0, 0.0])], "label string, vec array<double>")
    got = {r.text_id: (r.label, r.source, r.needs_judge) for r in cascade.study_types(texts, vectors, prototypes).collect()}
    assert got == {1: ("review", "rules_title_abstract", False), 2: ("case_study", "rules", False), 3: ("regional", "vectors", False), 4: ("regional", "vectors", True), 5: ("unknown", "no_vector", True), 6: ("case_study", "rules_flood_case", False)}


def test_parses(spark):
    schema = "k int, title string, formulas array<string>, tables array<string>"
    a = spark.createDataFrame([(1, " ", ["x = 1", "X=1", None, " "], []), (2, "t", None, ["a"]), (None, "n", [], None)], schema)
    b = spark.createDataFrame([(1, "u", ["x=1", "y"], ["b"]), (3, "v", None, None), (None, "m", None, None)], schema)
    got = {(r.k, r.title): (r.formulas, r.tables, r.sources) for r in parses.merged(a, b, "k", {"title": "first"}).collect()}
    assert got == {(1, "u"): (["x = 1", "y"], ["b"], "both"), (2, "t"): ([], ["a"], "first"), (3, "v"): ([], None, "second"), (None, "n"): ([], None, "first"), (None, "m"): ([], None, "second")}


@pytest.mark.parametrize("state, want", [({}, [1, 2, 3]), ({"topics": []}, [1, 2, 3]), ({"topics": ["a"]}, [1, 2]), ({"topics": ["a", "b"], "least": 2}, [2, 3]), ({"topics": ["none"]}, [])])
def test_filters_across_tables(spark, state, want):
    rows = spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "id int, score int")
    bridge = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (3, "b"), (None, "a")], "of int, topic string")
    assert sorted(r.id for r in predicates.selected(rows, state, {"least": "score"}, {"topics": (bridge, "of", "topic")}, "id").collect()) == want


def test_mentions(spark):
    texts = spark.createDataFrame([(1, "SWAT coupled with HEC-HMS, a 1D and 2D model"), (2, "SWAT coupled with SWAT"), (3, "coupled with HEC-HMS"), (4, None), (5, "SWAT " + "far " * 20 + "linked to HEC-HMS")], "text_id int, text string")
    models = spark.createDataFrame([("SWAT", "SWAT"), ("HEC HMS", "HMS")], "phrase string, name string")
    assert [tuple(r) for r in M.couplings(texts, models, 30).collect()] == [(1, "SWAT", "HMS", "coupled with", 0, 25)]
    assert {r.text_id: r.dimensions for r in M.dimensions(texts).collect()} == {1: ["1D", "2D", "coupled_1D_2D"], 2: [], 3: [], 4: [], 5: []}
    said = spark.createDataFrame([(1, 0, "the basin, a river"), (1, 1, "A river basin"), (1, 2, None)], "text_id int, ord int, sentence string")
    names = spark.createDataFrame([(1, "River basin"), (1, "basin river"), (1, "delta"), (2, "river")], "text_id int, name string")
    assert sorted(map(tuple, M.first_sentences(said, names).collect())) == [(1, "River basin", 1, "exact"), (1, "basin river", 0, "partial")]
