"""Operators on small literal tables: parametrised values, ties, nulls, invariants."""

import itertools
import math

import pytest
from pyspark.sql import functions as F

from marlstone.functions import numeric as N
from marlstone.functions import rules as R
from marlstone.functions import text as X
from marlstone.operators import chunking as C
from marlstone.operators import graphs as G
from marlstone.operators import joining as J
from marlstone.operators import predicates as P
from marlstone.operators import vectors as V
from marlstone.sources import tables as S

METRICS = [("f1_score", "97.2", 0.972), ("kappa", "-0.3", -0.3), ("kappa", "85", 0.85), ("nse", "-2.5", -2.5), ("nse", "1.7", None), ("r2", "87", 0.87), ("rmse", "-1", None), ("rmse", "145.2", 145.2), ("pbias", "-12.5%", -12.5), ("odd", "7,5", 7.5), ("f1_score", "n/a", None), ("f1_score", "250", None)]


def test_metric_values(spark):
    rows = spark.createDataFrame(list(enumerate(METRICS)), "i int, m struct<metric:string,raw:string,want:double>").select("i", "m.*")
    got = rows.join(F.broadcast(N.range_table(rows)), "metric", "left").withColumn("got", N.normalised(N.parsed(F.col("raw")))).collect()
    for r in got:
        assert (r.got is None) == (r.want is None) and (r.got is None or math.isclose(r.got, r.want)), r


@pytest.mark.parametrize("raw, unit", [("M3/s", "m³/s"), (" mm / d ", "mm/day"), ("", "unknown"), (None, "unknown"), ("meters", "m"), ("Furlong", "Furlong"), ("-", "dimensionless")])
def test_units(spark, raw, unit):
    row = spark.createDataFrame([(raw,)], "u string").select(N.canonical_unit(F.col("u")).alias("c"), N.comparable(F.col("u"), F.col("u")).alias("same")).first()
    assert row.c == unit and bool(row.same) == (unit != "unknown")


def test_midpoints(spark):
    cases = [("0.84-0.95", 0.895), (">94", 94.0), ("< 3.5", 3.5), ("7", 7.0), ("-2 - 4", 1.0), ("x", None), (None, None)]
    got = spark.createDataFrame([(a,) for a, _ in cases], "c string").select(N.midpoint(F.col("c")).alias("m")).collect()
    assert [r.m for r in got] == [b for _, b in cases]


def test_conjunction(spark):
    rows = spark.createDataFrame([("1999", "a", 5.0, True), ("99", "a", 9.0, True), (None, "b", 9.0, False), ("2001", "b", 1.0, None)], "y string, k string, v double, f boolean")
    names = {"year": "y", "kind": "k", "least": "v", "flag": "f"}
    count = lambda s: rows.filter(P.conjunction(s, names)).count()
    assert [count(s) for s in ({}, {"year_min": 1990}, {"kind": ["b"]}, {"least": 5}, {"least": 0}, {"flag": True}, {"flag": False}, {"year_min": 1990, "kind": ["a"], "flag": True})] == [4, 2, 2, 3, 4, 2, 4, 1]


def test_text_functions(spark):
    long = "abc " * 60
    texts = ["", "aaaa", "abab", long, "one two three four five", None, "\\${}x", "a b c d e f g"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", X.entropy(F.col("t")).alias("e"), X.top_gram_ratio(F.col("t")).alias("r"), X.symbol_density(F.col("t")).alias("s"), X.loops_on_its_start(F.col("t")).alias("l"), X.sequence_ratio(F.col("t"), F.lit("abab")).alias("q")
    ).collect()
    assert [round(r.e, 6) if r.e is not None else None for r in got[:3]] == [0.0, 0.0, 1.0]
    assert got[3].r == 1.0 and got[4].r == 0.0 and got[7].r == pytest.approx(1 / 3)
    assert got[6].s == pytest.approx(0.8) and got[2].q == 1.0 and got[5].q == 0.0


def test_rules_take_the_first(spark):
    rows = spark.createDataFrame([("Comparing NSE",), ("nothing",), ("basin",), (None,)], "c string").select(R.first_match(F.col("c"), R.TABLE_RULES, R.TABLE_DEFAULT).alias("x")).select("x.*").collect()
    assert [r.label for r in rows] == ["metrics_table", "data_table", "station_table", "data_table"]
    kinds = spark.createDataFrame([("Sentinel-1 and Sentinel-2",), ("ERS",), ("MODIS",), (" ",), (None,), ("Odd",)], "c string").select(R.sensor_kind(F.col("c")).alias("k")).collect()
    assert [r.k for r in kinds] == ["Multi-sensor", "SAR", "Optical", None, None, "Odd"]


@pytest.mark.parametrize("n", [0, 100, 119, 120, 1999, 2000, 2001, 3700, 3701, 5400, 9000])
def test_windows_end_where_the_text_ends(spark, n):
    text = "x" * n
    starts = [0]
    while starts[-1] + 2000 < n:
        starts.append(starts[-1] + 1700)
    want = [(k, s, min(s + 2000, n)) for k, s in enumerate(s for s in starts if len(text[s : s + 2000]) >= 120)]
    got = C.windows(spark.createDataFrame([(1, text)], "doc_id long, text string"), "doc_id", "text").orderBy("chunk_index").collect()
    assert [(r.chunk_index, r.char_start, r.char_end) for r in got] == want


def test_quality_gate(spark):
    cases = [("", "EMPTY"), ("short", "TOO_SHORT,LOW_ENTROPY"), ("la la la la la la la la la la", "REPETITION_LOOP,LOW_ENTROPY"), ("The river rose by two metres after heavy rain, and fields near it were flooded for days. [UNK]", "UNREADABLE")]
    rows = spark.createDataFrame([(t,) for t, _ in cases], "t string")
    score, flags = C.quality_gate(F.col("t"))
    got = rows.select(score.alias("s"), F.array_join(flags, ",").alias("f")).collect()
    assert [r.f for r in got] == [f for _, f in cases] and got[0].s == 0.0 and got[3].s == pytest.approx(0.75)


def test_asof_across_slices(spark):
    left = spark.createDataFrame([(1, "a", 10), (2, "a", 200_000), (3, "a", 5), (4, "b", 50), (5, "a", 400_000), (6, None, 50)], "id int, k string, s long").withColumn("ts", F.timestamp_seconds("s")).drop("s")
    right = spark.createDataFrame([("a", 10, 1), ("a", 10, 2), ("a", 100_000, 3), ("c", 1, 9)], "k string, s long, v int").withColumn("ts", F.timestamp_seconds("s")).drop("s")
    got = {r.id: r.asof_v for r in J.asof(left, right, "k", "ts", "v").collect()}
    assert got == {1: 2, 2: 3, 3: None, 4: None, 5: 3, 6: None}


def test_pairs_and_nearest(spark):
    rows = spark.createDataFrame([(1, "x"), (1, "y"), (1, "x"), (2, "y"), (2, "x"), (3, "z")], "g int, i string")
    assert [tuple(r) for r in J.pairs_within(rows, "g", "i", 2).collect()] == [("x", "y", 2)]
    a = spark.createDataFrame([(1, 1, 0.0, 0.0), (2, 1, 100.0, 0.0), (3, 2, 0.0, 0.0)], "id int, page int, x double, y double")
    b = spark.createDataFrame([(9, 1, -3.0, 4.0), (8, 1, 3.0, 4.0), (7, 1, 104.0, 0.0)], "id int, page int, x double, y double")
    assert sorted((r.left_id, r.right_id, r.distance) for r in J.nearest(a, b, "page", 5.0, "id", "id").collect()) == [(1, 8, 5.0), (2, 7, 4.0)]


def test_graph_operators(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4), (4, 4)], "src int, dst int")
    got = {(r.node, r.hops) for r in G.reached(edges, spark.createDataFrame([(1,)], "id int"), 3).collect()}
    assert got == {(2, 1), (3, 2), (4, 3)}
    boxes = [(k, k % 3, float(x), float(y), float(x + 4), float(y + 4)) for k, (x, y) in enumerate(itertools.product(range(0, 30, 5), range(0, 30, 3)))]
    df = spark.createDataFrame(boxes, "id int, page int, x0 double, y0 double, x1 double, y1 double")
    head = {b[0]: b[0] for b in boxes}
    for _ in boxes:
        for a, b in itertools.combinations(boxes, 2):
            if a[1] == b[1] and a[2] <= b[4] and b[2] <= a[4] and a[3] <= b[5] and b[3] <= a[5]:
                m = min(head[a[0]], head[b[0]])
                head[a[0]] = head[b[0]] = m
    assert {r.node: r.label for r in G.merged(df, "page").collect()} == head


def test_vectors(spark):
    rows = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [0.0, 0.0]), (100, [1.0, 1.0])], "vec_id long, embedding array<double>")
    got = [(r.id, round(r.similarity, 6)) for r in V.nearest(rows, rows.filter("vec_id = 0"), 3).orderBy("rank").collect()]
    assert got == [(1, 1.0), (100, 0.707107), (2, 0.0)]
    assert V.nearest(rows, rows.limit(0), 3).count() == 0
    assert [r.u for r in rows.select(V.usable(F.col("embedding")).alias("u")).collect()] == [True, True, True, False, True]


def test_tables(spark, tmp_path):
    a, b = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), spark.createDataFrame([(2, "c"), (3, "d"), (3, "d")], "k int, v string")
    once = S.upserted(a, b, ["k"])
    assert sorted((r.k, r.v) for r in once.collect()) == [(1, "a"), (2, "c"), (3, "d")]
    assert sorted(S.upserted(once, b, ["k"]).collect()) == sorted(once.collect())
    a.write.parquet(str(tmp_path / "t"))
    now = S.changed_files(spark, str(tmp_path / "t"), None).cache()
    assert now.count() >= 1 and S.changed_files(spark, str(tmp_path / "t"), now).count() == 0


def test_best_context(spark):
    from marlstone.operators.entities import best_context

    text = "a SAR b. " + "x" * 200 + " flood extent by SAR mapping of floods " + "y" * 200 + " SAR"
    rows = spark.createDataFrame([(text,), ("none here",), (None,), ("SAR",)], "t string").select(best_context("t", "SAR", ["flood", "map"], 30).alias("c")).collect()
    k = text.index("SAR mapping")
    assert [r.c for r in rows] == [text[k - 30 : k + 33], None, None, "SAR"]


def test_quantiles_and_samples(spark):
    import numpy as np

    from marlstone.operators.quantiles import exact_quantiles
    from marlstone.operators.sampling import stratified

    rng = np.random.default_rng(2)
    groups = {"a": rng.normal(size=301), "b": np.array([3.0]), "c": np.array([1.0, 1.0, 1.0, 9.0]), "d": np.concatenate([rng.random(200) * 1e-9, [1e9]])}
    rows = spark.createDataFrame([(g, float(v)) for g, vs in groups.items() for v in vs] + [("e", None)], "g string, v double")
    got = {r.g: r for r in exact_quantiles(rows, "g", "v", {"q25": 0.25, "q50": 0.5, "q99": 0.99, "q100": 1.0}).collect()}
    assert set(got) == set("abcd")
    for g, vs in groups.items():
        assert np.allclose([got[g].q25, got[g].q50, got[g].q99, got[g].q100], np.quantile(vs, [0.25, 0.5, 0.99, 1.0]))
    docs = spark.range(3000).select(F.col("id"), F.when(F.col("id") < 3, "small").otherwise("big").alias("s"))
    took = stratified(docs, "s", "id", 0.1, 5).groupBy("s").count().collect()
    assert {r.s: r["count"] for r in took} == {"small": 3, "big": 300}


def _boxes(spark, n=70):
    import random

    rng = random.Random(3)
    rows = []
    for k in range(n):
        x, y, w, h = rng.randint(-60, 120), rng.randint(-60, 120), rng.choice([0, 1, 5, 30, 90]), rng.choice([0, 2, 8, 20])
        rows.append((k + 100, k % 2, float(x), float(y), float(x + w), float(y + h)))
    rows += [(k + 900, *rows[k][1:]) for k in range(12)] + [(990, 0, 9.0, 9.0, 3.0, 3.0), (991, 0, 9.0, 9.0, 3.0, 3.0)]
    return rows, spark.createDataFrame(rows, "id long, page int, x0 double, y0 double, x1 double, y1 double").repartition(3)


@pytest.mark.parametrize("least", [0.0, 2.0])
def test_boxes_of_many_sizes_are_merged(spark, least):
    boxes, df = _boxes(spark)
    head = {b[0]: b[0] for b in boxes}
    for _ in boxes:
        for a, b in itertools.combinations(boxes, 2):
            if a[1] == b[1] and a[2] <= b[4] + least and b[2] <= a[4] + least and a[3] <= b[5] + least and b[3] <= a[5] + least:
                head[a[0]] = head[b[0]] = min(head[a[0]], head[b[0]])
    assert {r.node: r.label for r in G.merged(df, "page", least).collect()} == head


def test_merged_makes_no_pairs_of_what_a_point_unites(spark, monkeypatch):
    made = []
    monkeypatch.setattr(G, "stored", lambda df, name: made.append((name, S.stored(df, name))) or made[-1][1])
    df = spark.range(3000).selectExpr("id", "0 as page", "double(id % 40) as x0", "double(id % 23) as y0", "double(id % 40 + 30) as x1", "double(id % 23 + 20) as y1")
    assert G.merged(df, "page").select("label").distinct().count() == 1
    assert max(t.count() for name, t in made if name == "touching") < 50_000  # of nine million pairs


@pytest.mark.parametrize("block", [2, 512])
def test_overlapping_pairs_with_copies(spark, block):
    boxes, df = _boxes(spark)
    boxes = [b for b in boxes if b[0] < 990]

    def iou(a, b):
        both = max(0, min(a[4], b[4]) - max(a[2], b[2])) * max(0, min(a[5], b[5]) - max(a[3], b[3]))
        area = lambda c: (c[4] - c[2]) * (c[5] - c[3])
        union = area(a) + area(b) - both
        return both / union if union > 0 else 0.0

    want = {(a[0], b[0]) for a in boxes for b in boxes if a[1] == b[1] and a[0] < b[0] and iou(a, b) > 0.3}
    got = J.overlapping(df.filter("id < 990"), "page", 0.3, block=block).collect()
    assert len(got) == len(want) and {(r.a, r.b) for r in got} == want


def test_overlap_is_worked_out_once_for_copies(spark, monkeypatch):
    made = {}
    monkeypatch.setattr(J, "stored", lambda df, name: made.setdefault(name, S.stored(df, name)), raising=False)
    df = spark.range(600).selectExpr("id", "0 as page", "double(id % 3) as x0", "0D as y0", "double(id % 3 + 10) as x1", "8D as y1")
    assert J.overlapping(df, "page", 0.5).count() == 600 * 599 // 2
    assert made["near"].count() == 6


def test_a_brand_of_another_part_is_new_for_a_part_that_has_its_own(spark):
    from marlstone.operators import refine

    entities = spark.createDataFrame([("e.1", "One", ["Brand#1"]), ("e.1000001", "Other", ["Brand#2"])], "entity_id string, name string, aliases array<string>")
    patches = spark.createDataFrame([("e.1", "Brand#1"), ("e.1000001", "Brand#1"), ("e.1000002", "Brand#1")], "entity_id string, alias string")
    got = {r.entity_id: r.outcome for r in refine.expanded(entities, patches)[1].collect()}
    assert got == {"e.1": "duplicate", "e.1000001": "added", "e.1000002": "missing_target"}
