"""Chunks and rows of laid-out documents on small cases, against plain versions."""

import math
import random

import pytest
from pyspark.sql import functions as F

from marlstone.operators import layout as L


def laid(spark, sections=(), sentences=(), floats=(), abstracts=()):
    return L.Layout(
        spark.createDataFrame(list(sections), "doc string, section int, title string, level int, n string, coords string"),
        spark.createDataFrame(list(sentences), "doc string, section int, paragraph int, place int, text string, citations array<string>, coords string, paragraph_coords string"),
        spark.createDataFrame(list(floats), "doc string, kind string, ord int, xml_id string, label string, text string, coords string, cells array<array<string>>"),
        spark.createDataFrame(list(abstracts), "doc string, text string"),
    )


def test_boxes(spark):
    rows = [("1,2,3.5,4,5",), ("x;2, 1 ,1,1,.5;3,1,1,1",), ("",), (None,), ("1,a,2,3,4",), ("99999999999,1,1,1,1; -1,1e1,+2,3.,4",)]
    got = [r.b for r in spark.createDataFrame(rows, "c string").select(L.boxes("c").alias("b")).collect()]
    told = [[tuple(b) for b in r] if r else None for r in got]
    assert told == [[(1, 2.0, 3.5, 4.0, 5.0)], [(2, 1.0, 1.0, 1.0, 0.5)], None, None, None, [(-1, 10.0, 2.0, 3.0, 4.0)]]


def test_nearest_float_by_brute_force(spark):
    rng = random.Random(5)
    box = lambda: (rng.randint(1, 2), rng.randint(-300, 900), rng.randint(0, 900), rng.choice([0, 10, 200]), 20)
    told = lambda bs: ";".join(",".join(map(str, b)) for b in bs)
    els = {(d, k): [box() for _ in range(rng.randint(1, 3))] for d in "ab" for k in range(60)}
    fl = {(d, kind, o): [box() for _ in range(rng.randint(1, 2))] for d in "ab" for kind in ("figure", "table", "formula") for o in range(9)}
    elements = spark.createDataFrame([(d, k, told(b)) for (d, k), b in els.items()] + [("a", 999, None)], "doc string, k int, coords string")
    floats = laid(spark, floats=[(d, kind, o, f"{kind}{o}", "", "", told(b), None) for (d, kind, o), b in fl.items()]).floats
    got = {(r.doc, r.k): (r.figure and r.figure.xml_id, r.table and r.table.xml_id) for r in L.nearest_floats(elements, ["doc", "k"], floats).collect()}

    def plain(d, bs, kind):
        mid = lambda b: (b[1] + b[3] / 2, b[2] + b[4] / 2)
        near = [(math.dist(mid(a), mid(b)), o) for (fd, fk, o), fbs in fl.items() if (fd, fk) == (d, kind) for a in bs for b in fbs if a[0] == b[0]]
        near = [x for x in near if x[0] <= L.NEAR]
        return f"{kind}{min(near)[1]}" if near else None

    want = {k: (plain(k[0], b, "figure"), plain(k[0], b, "table")) for k, b in els.items()}
    assert got == {k: v for k, v in want.items() if any(v)} and 20 < len(got) < len(els)


def test_what_a_section_lies_in(spark):
    levels = [2, 1, 3, 2, 3, 9, 1, 3, 2]
    got = {}
    for r in L.within_sections(laid(spark, sections=[("d", k, "t", lv, "", None) for k, lv in enumerate(levels)]).sections).collect():
        got.setdefault(r.section, set()).add(r.within)
    open_, want = [], {}
    for k, lv in enumerate(levels):
        open_ = [j for j in open_ if levels[j] < lv] + [k]
        want[k] = set(open_)
    assert got == want


LONG = "This sentence is long enough."


def test_chunks_of_a_small_document(spark):
    doc = laid(
        spark,
        [("d", 0, "Introduction to it", 1, "", None), ("d", 1, "Inside", 2, "1.1", "3,0,0,5,5"), ("d", 2, None, 1, None, None)],
        [("d", 0, 0, 0, LONG, ["b1"], "1,0,0,10,10", "9,0,0,1,1"), ("d", 0, 0, 1, "Short.", None, None, "9,0,0,1,1"), ("d", 1, 0, 0, LONG, ["b2", "b3"], None, None), ("d", 2, 0, 0, "", [], None, None), ("d", 2, 0, 1, None, [], None, None)],
        [("d", "figure", 0, "f0", "Figure with a long label", "", "1,0,100,10,10", None), ("d", "table", 0, None, None, None, None, None), ("d", "formula", 0, "m0", "a label that is not used", "y = a * x + b + c + d", None, None)],
        [("d", "About what this document is."), ("e", None)],
    )
    rows = L.chunks(doc, ("sentence", "paragraph", "section")).collect()
    got = {(r.chunk_type, r.section_n): r for r in rows}
    assert len(got) == len(rows) == 9 and len({r.chunk_id for r in rows}) == 9
    first = got["sentence", ""]
    assert (first.page, first.w, first.near_figure, first.figure_id, first.near_table, first.citations) == (1, 10.0, True, "f0", False, ["b1"])
    assert (got["sentence", "1.1"].page, got["sentence", "1.1"].x, got["sentence", "1.1"].near_figure) == (0, None, False)
    assert (got["paragraph", ""].text, got["paragraph", ""].page, got["paragraph", ""].near_figure) == (LONG + " Short.", 9, False)
    assert (got["section", ""].text, got["section", ""].citations) == (LONG + " Short.\n\n" + LONG, ["b1", "b2", "b3"])
    assert got["section", "1.1"].page == 3 and got["abstract", ""].page == 1
    assert (got["figure", "f0"].text, got["figure", "f0"].near_figure, got["formula", "m0"].section_title) == ("Figure with a long label", True, "Formula")
    only = {r.chunk_type for r in L.chunks(doc).collect()}
    assert only == {"abstract", "sentence", "figure", "formula"}
    with pytest.raises(ValueError):
        L.chunks(doc, ("word",))


def test_repeated_sentences_stay_as_many(spark):
    row = ("d", 0, 0, 0, LONG, [], "1,0,0,10,10", None)
    got = L.chunks(laid(spark, [("d", 0, "T", 1, "", None)], [row, row]), ("sentence",)).collect()
    assert len(got) == 2 and len({r.chunk_id for r in got}) == 1


def test_rows_of_parts(spark):
    cells = [["Site", None], ["a", "0,5"]]
    doc = laid(
        spark, [("d", 0, "", 1, "", "2,1,1,3,4")], [], [("d", "figure", 0, "f", "", "A map", None, None), ("d", "figure", 1, "", "F2", "", "2,1,1,3,4", None), ("d", "table", 0, "t", "T", "Scores", "4,0,0,1,1", cells), ("d", "table", 1, "u", "", None, None, []), ("d", "formula", 0, "m", None, "", None, None)],
    )
    s = L.section_rows(doc).first()
    assert (s.section_id, s.title, s.n, s.text, s.word_count, s.page, s.bbox_x1, s.bbox_y1) == ("d_sec_000", None, None, None, 0, 2, 4.0, 5.0)
    assert [(r.figure_id, r.xml_id, r.label, r.caption, r.page) for r in L.figure_rows(doc).orderBy("figure_id").collect()] == [("d_fig_000", "f", None, "A map", None), ("d_fig_001", None, "F2", None, 2)]
    assert [(r.header_row, r.row_count, r.col_count, r.has_numeric_data) for r in L.table_rows(doc).orderBy("table_id").collect()] == [(["Site", None], 2, 2, True), (None, 0, 0, False)]
    assert [(r.caption_id, r.parent_id, r.parent_type, r.page) for r in L.caption_rows(doc).orderBy("caption_id").collect()] == [("d_cap_000", "d_fig_000", "figure", None), ("d_cap_001", "d_tbl_000", "table", 4)]
    assert L.equation_rows(doc).first().text is None


def test_empty_tables(spark):
    empty = laid(spark)
    for rows in (L.chunks(empty, ("sentence", "paragraph", "section")), L.section_rows(empty), L.figure_rows(empty), L.table_rows(empty), L.equation_rows(empty), L.caption_rows(empty)):
        assert rows.count() == 0
    assert empty.sections.select(F.lit(1)).isEmpty()
