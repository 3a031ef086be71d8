"""Typed objects, section order, summaries of papers, people of TEI documents and sentences of Markdown on small cases."""

from marlstone.operators import objects as O
from marlstone.sources import markdown as M
from marlstone.sources import tei as TEI


def parts(spark, sections=(), figures=(), tables=(), equations=(), references=()):
    make = spark.createDataFrame
    return (
        make(list(sections), "section_id string, doc string, title string, text string, page int, extra int"), make(list(figures), "figure_id string, doc string, label string, caption string, page int"),
        make(list(tables), "table_id string, doc string, label string, caption string, header_row array<string>, page int"), make(list(equations), "equation_id string, doc string, text string, page int"), make(list(references), "ref_id string, doc string, raw string, title string"),
    )


def test_objects(spark):
    long_text = "LSTM and swat, then lstm. NSE, R2. " * 60_000  # over 2 MB
    got = {r.object_id: r for r in O.typed_objects(*parts(
        spark, [("s1", "d", "Methods", long_text, 1, 0), ("s2", "d", None, None, None, 0)], [("f1", "d", "Figure 1", None, 2), ("f2", "d", None, "Daily discharge by Sentinel", 2)], [("t1", "d", "Table 1", "Sites", ["Lat", "KGE"], 3), ("t2", "d", None, None, [], 3), ("t3", "d", None, None, None, 3)],
        [("e1", "d", "  NSE = 1 - kge ", 4), ("e2", "d", None, 4)], [("r1", "d", "", "A title"), ("r2", None, "raw", None)],
    )).collect()}
    assert len(got) == 11
    s = got["s1"]
    assert (s.object_type, s.semantic_type, s.classifier_score, len(s.raw_text), s.candidate_models, s.candidate_metrics) == ("section", "methods_section", 0.9, 2000, ["LSTM", "SWAT"], ["NSE", "R2"])
    assert (s.contains_models, s.contains_metrics, s.contains_timeseries) == (True, True, False)
    assert (got["s2"].raw_text, got["s2"].candidate_models, got["s2"].contains_models) == ("", None, False)
    assert (got["f1"].raw_text, got["f2"].contains_timeseries, got["f2"].contains_satellite, got["f2"].contains_hydrograph) == (None, True, True, True)
    assert (got["t1"].candidate_vars, got["t1"].contains_coordinates, got["t1"].candidate_metrics) == (["Lat", "KGE"], True, ["KGE"]) and got["t2"].candidate_vars is got["t3"].candidate_vars is None
    assert (got["e1"].equation_name, got["e1"].raw_text, got["e2"].equation_name) == ("NSE", "  NSE = 1 - kge ", None)
    assert (got["r1"].raw_text, got["r1"].semantic_type, got["r1"].page, got["r2"].raw_text, got["r2"].contains_models) == ("A title", "reference", None, "raw", False)
    assert O.typed_objects(*parts(spark)).count() == 0


def test_order_of_sections(spark):
    rows = [(f"{d}{k:03d}", d, k) for d, n in (("a", 5), ("b", 1), ("c", 40)) for k in range(n)]
    got = {(r.source_id, r.target_id) for r in O.follows(spark.createDataFrame(rows, "section_id string, doc string, ord int").repartition(5)).collect()}
    assert got == {(f"{d}{k:03d}", f"{d}{k + 1:03d}") for d, n in (("a", 5), ("c", 40)) for k in range(n - 1)}


def test_summaries(spark):
    make = spark.createDataFrame
    papers = make([("p",), ("p",), ("q",)], "paper_id string")
    facts = make([("p", "NSE", 0.5), ("p", "NSE", 0.5), ("p", "KGE", None), ("p", None, 1.0), ("x", "NSE", 1.0)], "paper_id string, metric string, value double")
    regions = make([("p", "TABLE_REGION", None, ""), ("p", None, None, "x")], "paper_id string, region_type string, latex string, text string")
    got = {r.paper_id: r.asDict() for r in O.summaries(papers, facts, None, make([("q", None), ("q", True)], "paper_id string, has_numeric_data boolean"), regions).collect()}
    p, q = got["p"], got["q"]
    assert len(got) == 2 and p["metrics"] == ["KGE", "NSE"] and p["metric_values"] == {"KGE": [], "NSE": [0.5, 0.5]} and p["n_facts"] == 4
    assert (p["regions_count"], p["formula_regions"], p["table_regions"], p["has_second_content"], p["n_tables"], p["n_formulas"]) == (2, 0, 1, True, None, None)
    assert (q["metrics"], q["n_tables"], q["n_numeric_tables"], q["regions_count"]) == (None, 2, 1, None)
    none = O.summaries(papers, None, make([], "paper_id string, formula_class string"), None, None)
    assert none.count() == 2 and none.columns == O.summaries(papers, facts, None, None, regions).columns


def test_people_of_tei(spark):
    wrap = "<TEI><teiHeader><fileDesc><sourceDesc><biblStruct><analytic>{}</analytic></biblStruct></sourceDesc></fileDesc></teiHeader></TEI>"
    docs = [
        ("a", wrap.format(
            "<author><persName><forename>Jo</forename><surname> Ash </surname></persName><affiliation key='k0'><orgName type='institution'>One &amp; all</orgName><orgName type='department'/><address><postCode>1</postCode><country>X</country></address></affiliation></author>"
            "<author><persName><surname>Elm</surname></persName><affiliation key='k0'><orgName type='institution'>Other</orgName></affiliation><affiliation><orgName type='laboratory'>L</orgName></affiliation><affiliation key='k0'/></author><author/>")),
        ("b", wrap.format("<author><persName><surname>Fir</surname></persName></author>")), ("c", None), ("d", "<TEI><broken"), ("e", wrap.format("")),
    ]
    trees = TEI.parsed(spark.createDataFrame(docs, "doc_id string, xml string"))
    people = sorted((r.doc_id, r.ord, r.forenames, r.surname, r.email, tuple(r.affiliations)) for r in TEI.authors(trees).collect())
    assert people == [("a", 0, "Jo", "Ash", None, ("k0",)), ("a", 1, None, "Elm", None, ("k0",)), ("b", 0, None, "Fir", None, ())]
    places = {(r.doc_id, r.key): r for r in TEI.affiliations(trees).collect()}
    first = places["a", "k0"]
    assert set(places) == {("a", "k0"), ("a", None)}
    assert (first.institution, first.department, first.settlement, first.country, first.country_code, first.address) == ("One & all", None, None, "X", None, "1, X")
    assert (places["a", None].laboratory, places["a", None].address) == ("L", None)


def test_sentences_of_markdown(spark):
    text = "Loose one. Two\nends here? yes.\n\n# Head\nA b.\n$$ x = 1 $$\n...\nC d! \u00c9e.\n## Next\n| a | b |\n---"
    rows = [("a", text), ("b", None), ("c", ""), ("d", "word. " * 50_000 + "End")]
    got = sorted((r.doc_id, r.ord, r.paragraph, r.place, r.sentence) for r in M.sentences(M.lines(spark.createDataFrame(rows, "doc_id string, text string"))).collect())
    assert got[:6] == [("a", 0, 0, 0, "Loose one."), ("a", 0, 0, 1, "Two ends here? yes."), ("a", 1, 0, 0, "A b."), ("a", 1, 1, 0, "C d!"), ("a", 1, 1, 1, "\u00c9e."), ("d", 0, 0, 0, "word. " * 49_999 + "word.")]
    assert [r[:4] for r in got[6:]] == [("d", 0, 0, 1)]
