"""Documents, tables of cells, aliases and checks on small cases of their edges."""

import re

import pytest
from pyspark.sql import functions as F

from marlstone.operators import aliases as A
from marlstone.operators import checks as C
from marlstone.operators import entities as E
from marlstone.operators import property_graph as G
from marlstone.operators import reasoning, registry, tables
from marlstone.operators import vectors as V
from marlstone.plans import catalog
from marlstone.sources import markdown as M
from marlstone.sources import tables as S
from marlstone.sources import tei as TEI


def cells(spark, rows):
    return spark.createDataFrame(rows, "table_id string, row_no int, cells array<string>")


def test_headers_in_several_rows(spark):
    rows = [("t", 0, ["", "Calibration", None]), ("t", 1, ["Gauge", "NSE", "RMSE (m³/s)"]), ("t", 2, ["A", "0,81", "12"]), ("t", 3, ["B", "7", " 3% "])]
    got = {(r.row_no, r.place): r for r in tables.numeric_facts(cells(spark, rows)).collect()}
    assert set(got) == {(2, 1), (2, 2), (3, 2)}  # an efficiency of 7 isn't plausible
    assert (got[2, 1].metric, got[2, 1].value, got[2, 1].header, got[2, 1].row_labels) == ("metric.nse", 0.81, "Calibration NSE", ["A"])
    assert (got[2, 2].metric, got[2, 2].unit) == ("metric.rmse", "m³/s") and got[3, 2].value == 3.0
    assert all(r.confidence == 0.85 for r in got.values())


def test_rows_are_read_only_if_columns_give_nothing(spark):
    rows = [("r", 0, [None, "Nash", "0.4", "0.5", "x"]), ("r", 1, ["SCS", "CN (-)", "76", "79", "101"]), ("c", 0, ["KGE", "PBIAS"]), ("c", 1, ["0.2", "5"]), ("e", 0, []), ("h", 0, ["NSE", "KGE"])]
    got = sorted((r.table_id, r.metric, r.value, r.unit, r.confidence) for r in tables.numeric_facts(cells(spark, rows)).collect())
    assert got == [("c", "metric.kge", 0.2, None, 0.85), ("c", "metric.pbias", 5.0, "%", 0.85), ("r", "method.scs_cn", 76.0, "-", 0.8), ("r", "method.scs_cn", 79.0, "-", 0.8), ("r", "metric.nse", 0.4, None, 0.8), ("r", "metric.nse", 0.5, None, 0.8)]
    assert tables.numeric_facts(cells(spark, rows[:0])).count() == 0


@pytest.mark.parametrize("header, metric", [("Mean Bias Error", "metric.mbe"), ("R2", "metric.r2"), ("cc", "metric.r"), ("Overall Acc.", "metric.overall_accuracy"), ("hit rate", "metric.pod"), ("width", None), ("Cn", "method.scs_cn"), ("scn", None)])
def test_first_header_rule(spark, header, metric):
    r = spark.createDataFrame([(header,)], "h string").select(tables.metric_of(F.col("h")).alias("m")).first().m
    assert (r.metric if r else None) == metric


def test_markdown(spark):
    text = "before\n# A\ntext\n$$ x $$\n$$\ny\n$$\n### C\n| a | b |\n|---|---|\n| 1 | 2 |\n\n| c | d |\n## B\n\\[ z \\]\n# References\nSmith 10.1234/Ab.c\nagain 10.1234/aB.c\n$$ open"
    lined = M.lines(spark.createDataFrame([(1, text), (2, None), (3, "no heading")], "doc_id int, text string"))
    got = {(r.doc_id, r.ord): r for r in M.sections(lined).collect()}
    assert [(got[1, k].title, got[1, k].level, got[1, k].parent, got[1, k].n_formulas, got[1, k].n_tables) for k in range(1, 5)] == [("A", 1, None, 2, 0), ("C", 3, 1, 0, 2), ("B", 2, 1, 1, 0), ("References", 1, None, 1, 0)]
    assert got[1, 0].n_lines == 1 and got[3, 0].n_lines == 1 and (2, 0) not in got
    refs = M.references(lined).collect()
    assert [(r.key, r.ref, r.n) for r in refs] == [("doi:10.1234/ab.c", "Smith 10.1234/Ab.c", 2)]
    assert sorted((r.row_no, tuple(r.cells)) for r in M.table_cells(lined).collect()) == [(0, ("a", "b")), (0, ("c", "d")), (1, ("1", "2"))]


def test_tei_that_is_not_whole(spark):
    docs = spark.createDataFrame([(1, None), (2, "plain"), (3, "<TEI><text><body><div><head>H</head></div></body></text></TEI>"), (4, "<TEI><text>"), (5, "<TEI/>")], "doc_id int, xml string")
    trees = TEI.parsed(docs)
    assert [r.doc_id for r in trees.collect()] == [3]
    h = TEI.headers(trees).first()
    assert (h.title, h.authors, h.n_sections, h.n_tables, h.n_references) == (None, [], 1, 0, 0)
    assert TEI.table_cells(trees).count() == TEI.references(trees).count() == 0 and TEI.sections(trees).first().paragraphs == []


def test_alias_cascade(spark):
    entities = spark.createDataFrame([("method.hec_ras", 1, "HEC-RAS", ["hec ras 2d"]), ("sensor.s1", 2, "Sentinel-1", None), ("method.rf", 3, "Random Forest", ["rf"]), ("metric.rf", 4, "Runoff factor", ["RF"])], "entity_id string, ord int, name string, aliases array<string>")
    mentions = spark.createDataFrame([(1, "HEC RAS", "method"), (2, "hec_ras model data", "method"), (3, "the new Sentinel-1 SAR scenes", "method"), (4, "RF", "method"), (5, None, "method"), (6, "--", "x"), (7, "random", "method"), (8, "Sentinel 1 classifier", "metric")], "mention_id int, mention string, kind string")
    table = A.alias_table(entities)
    got = {r.mention_id: (r.entity_id, r.how) for r in A.resolved(mentions, table).collect()}
    assert got == {1: ("method.hec_ras", "exact"), 2: ("method.hec_ras", "truncated"), 3: ("sensor.s1", "phrase"), 4: ("metric.rf", "exact"), 5: (None, "unknown"), 6: (None, "unknown"), 7: (None, "unknown"), 8: ("sensor.s1", "truncated")}
    fits = F.split_part("entity_id", F.lit("."), F.lit(1)) == F.col("kind")
    assert {r.mention_id: r.entity_id for r in A.resolved(mentions, table, fits).collect()}[8] is None
    few = A.contained(spark.createDataFrame([(1, "Random forest of Sentinel-1 with hec ras 2D")], "text_id int, text string"), table, 2).collect()
    assert [(r.rank, r.entity_id) for r in sorted(few)] == [(1, "method.rf"), (2, "method.hec_ras")] or [(r.rank, r.entity_id) for r in sorted(few, key=lambda r: r.rank)] == [(1, "method.rf"), (2, "method.hec_ras")]


@pytest.mark.parametrize("value, text, found", [(0.94, "it was 94%", True), (0.94, "it was 0.9400", False), (0.94, "it was 0.94.", True), (0.94, "194 of 1940", False), (0.5, "", False), (0.123, "12.3 %", True)])
def test_literal(spark, value, text, found):
    assert spark.createDataFrame([(value, text)], "v double, t string").select(C.literal_in(F.col("v"), F.col("t")).alias("x")).first().x == found


@pytest.mark.parametrize("snippet, value, kind", [
    ("an overall accuracy of 91.5%", 0.915, "OA"), ("kappa of 80% and then 91%", 0.91, None), ("in 12% of cases kappa was 90%", 0.9, None), ("omission error and F1 of 88%", 0.88, None), ("omission error. The F1 of 88%", 0.88, "F1"),
    ("user's accuracy was 70 %", 0.7, "Precision"), ("nothing of the kind 70%", 0.7, None), ("kappa of 80", 0.8, None), (None, 0.8, None),
])
def test_percent_repair(spark, snippet, value, kind):
    assert spark.createDataFrame([(snippet, value)], "s string, v double").select(C.reclassified(F.col("s"), F.col("v")).alias("k")).first().k == kind


def test_semantic_rules_fire_together(spark):
    rows = [(1, "figure", "Simulated hydrograph, observed too", "Results", "x"), (2, "table", "NSE of LSTM and SWAT", "The results", ""), (3, "equation", "Saint-Venant with Manning", "Methods", "HEC-RAS in a channel"), (4, "figure", None, None, None)]
    got = {r.object_id: r for r in reasoning.annotated(spark.createDataFrame(rows, "object_id int, kind string, caption string, section string, around string")).collect()}
    assert [f[:3] for f in got[1].fired] == ["R01", "R02", "R03", "R14"] and got[1].confidence == 1.0 and got[1].roles == ["model_output", "observed_vs_simulated", "model_validation"]
    assert [f[:3] for f in got[2].fired] == ["R07", "R08"] and got[2].models == ["LSTM", "SWAT"]
    assert [f[:3] for f in got[3].fired] == ["R10", "R12"] and got[4].fired == [] and got[4].confidence == 0.35


def test_numbered_over_stretches(spark, monkeypatch):
    monkeypatch.setattr(E, "STRETCH", 3)
    ids = [0, 1, 2, 7, 8, 20, 21, 22]
    rows = spark.createDataFrame([(i, g) for i in ids for g in ("a", "b")], "id long, g string")
    got = {(r.g, r.id): r.follows for r in E.numbered(rows, "g", "id").collect()}
    assert got == {(g, i): (ids[k - 1] if k else None) for k, i in enumerate(ids) for g in ("a", "b")}


def test_nearest_over_blocks(spark, monkeypatch):
    """Blocks of queries and many batches give what one product gives."""
    import numpy as np

    rng = np.random.default_rng(2)
    vecs = rng.normal(size=(300, 8))
    base = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vecs)], "vec_id long, embedding array<double>").repartition(5)
    monkeypatch.setattr(V, "BLOCK", 7)
    got = {(r["query"], r["rank"]): r["id"] for r in V.nearest(base, base.filter("vec_id % 10 = 0"), 4).collect()}
    unit = vecs / np.linalg.norm(vecs, axis=1, keepdims=True)
    for q in range(0, 300, 10):
        sim = np.round(unit @ unit[q], 9)
        sim[q] = -9
        assert [got[q, k + 1] for k in range(4)] == np.lexsort((np.arange(300), -sim))[:4].tolist()


def test_graph_and_registry_edges(spark):
    rows = spark.createDataFrame([(1, "m", 0.2), (1, "m", 0.5), (2, None, 0.1)], "p int, m string, w double")
    nodes, edges = G.derived([G.Phase("USES", rows, ("Paper", F.col("p")), ("Method", F.col("m")), F.col("w"))])
    assert edges.count() == 1 and edges.first().weight == 0.5 and sorted((r.label, r.id) for r in nodes.collect()) == [("Method", "m"), ("Paper", "1")]
    old = spark.createDataFrame([(1, 9)], "k int, schema_version int")
    assert registry.migrated(old, [(2, {"x": F.lit(1)})]).first().x is None
    empty = spark.createDataFrame([], "k int")
    assert registry.register_counts(empty, empty, "k").first() == (0, 0, 0)
    merged = S.merged_graph(spark.createDataFrame([(1, 2, 0.5)], "a int, b int, c double"), spark.createDataFrame([(1, 2, 0.4), (1, 3, 0.1)], "a int, b int, c double"), ["a", "b"], F.col("c"))
    assert sorted(tuple(r) for r in merged.collect()) == [(1, 2, 0.5), (1, 3, 0.1)]


def test_merged_boxes_by_brute_force(spark):
    import random

    from marlstone.operators.graphs import merged

    rng = random.Random(3)
    boxes = [(i, i % 3, x := rng.uniform(-300, 300), y := rng.uniform(-300, 300), x + rng.uniform(0, 90), y + rng.uniform(0, 90)) for i in range(120)]
    label = {b[0]: b[0] for b in boxes}
    for _ in boxes:
        for a in boxes:
            for b in boxes:
                if a[1] == b[1] and a[2] <= b[4] + 2 and b[2] <= a[4] + 2 and a[3] <= b[5] + 2 and b[3] <= a[5] + 2:
                    label[a[0]] = label[b[0]] = min(label[a[0]], label[b[0]])
    df = spark.createDataFrame(boxes, "id int, page int, x0 double, y0 double, x1 double, y1 double")
    assert {r.node: r.label for r in merged(df, "page", 2.0).collect()} == label
    assert len(set(label.values())) < 110


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["s_tei_documents", "s_tei_references", "s_tei_authors", "s_tei_affiliations"])
def test_tei_texts_are_parsed_once(spark, sf_dir, name):
    df = catalog.QUERIES[name](spark, sf_dir)
    assert _plan(df).count("from_xml(") == 1


def test_tei_documents_are_dealt_out_before_they_are_made(spark, sf_dir):
    from marlstone.plans.documents import tei_documents
    from marlstone.plans.registry import Tables

    docs = tei_documents(Tables(spark, sf_dir))
    assert docs.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert "xml" not in _plan(docs).split("Repartition")[-1]  # keys are dealt out, not texts


def test_parts_of_tei_are_read_as_of_the_whole(spark):
    docs = spark.createDataFrame([
        (1, None), (2, "plain"), (3, "<TEI><text><body><div><head>H</head></div></body><back><listBibl><biblStruct><idno>10.1/A</idno></biblStruct></listBibl></back></text></TEI>"),
        (4, "<TEI><text><back><listBibl><biblStruct/><biblStruct><idno>x</idno></biblStruct></listBibl></back><body><div>"), (5, "<TEI/>"),
        (6, "<TEI><teiHeader/><text><body><div/><div><head>Second</head></div></body></text></TEI>"), (7, "<TEI><teiHeader><fileDesc><titleStmt><title>T</title></titleStmt></fileDesc></teiHeader></TEI>"),
    ], "doc_id long, xml string")
    rows = lambda df: sorted(map(str, df.collect()))
    whole = TEI.parsed(docs)
    assert rows(TEI.references(TEI.parsed(docs, parts=["back"]))) == rows(TEI.references(whole)) and TEI.references(whole).count() == 1
    assert rows(TEI.sections(TEI.parsed(docs, parts=["body"]))) == rows(TEI.sections(whole))
    first = TEI.with_first_section(whole).select("doc_id", "first.*")
    assert rows(first) == rows(TEI.sections(whole).filter("ord = 0").drop("ord")) and first.count() == 2


def test_people_are_shuffled_as_numbers(spark, sf_dir):
    from marlstone.plans.documents import tei_people
    from marlstone.plans.registry import Tables

    plan = _plan(tei_people(Tables(spark, sf_dir)))
    assert re.search(r"collect_list\(struct\(l_linenumber, l_linenumber#\d+L?, l_suppkey, l_suppkey#\d+L?\)", plan)
