"""Mixing: targets against pouring by hand, every word of a source's stream counted once, positions against the integral, hot sources, reruns."""

import random
from collections import defaultdict

import pytest

from marlstone.llm import curriculum as C

DOCS = "doc_id long, text string, source string, size long, place int, slice int"


def docs_of(spark, rows, parts=6):
    return spark.createDataFrame([(*r, 9, 9, 9) for r in rows], DOCS).repartition(parts)


def poured(sizes, weights=(5, 2, 1)):
    """{source: target}, filling up one source after the other."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    out, open_ = {}, set(names)
    rest = 1.5 * sum(sizes.values())
    while open_:
        level = rest / sum(weight[s] for s in open_)
        over = {s for s in open_ if 2 * sizes[s] < level * weight[s]}
        if not over:
            return out | {s: level * weight[s] for s in open_}
        for s in over:
            out[s], rest = 2 * sizes[s], rest - 2 * sizes[s]
        open_ -= over
    return out


def sample(seed, n, sources):
    rng = random.Random(seed)
    return [(k, " ".join("w" for _ in range(rng.choice([0, 1, 5, 40, 300]))), rng.choice(sources + sources[:1] * 6)) for k in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_takes_its_target(spark, seed):
    rows = sample(seed, 400, ["b", "", "a", None, "é", "Z"])
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(t.split())
    want = poured(sizes)
    got = C.mixed(docs_of(spark, rows)).collect()
    assert len(got) == len(rows)
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r.size and r.taken == sum(p.words for p in r.passes)
        taken[r.source] += r.taken
    for s, n in taken.items():
        assert abs(n - want[s]) <= 1


def test_order_and_reruns(spark):
    rows = sample(5, 300, ["a", "b", "c", "d"])
    mix = C.mixed(docs_of(spark, rows))
    again = C.mixed(docs_of(spark, rows[::-1], 11))
    key = lambda df: sorted(map(repr, df.collect()))
    assert key(mix) == key(again)
    order = C.training_order(mix).collect()
    assert [r.position for r in order] == sorted(r.position for r in order) and all(0 <= r.position <= 1 for r in order)
    # in order of position, a source's words up to a document have just been asked for
    target = {r.source: r.target for r in mix.collect()}
    given = defaultdict(int)
    for r in order:
        knots = C.SCHEDULES[sorted(target).index(r.source) % 3]
        (_, a), (_, b) = knots
        asked = (a * r.position + (b - a) * r.position**2 / 2) / ((a + b) / 2) * target[r.source]
        assert asked == pytest.approx(given[r.source], abs=1e-6 * target[r.source])
        given[r.source] += r.words


def test_positions_of_several_knots(spark):
    knots = ((0.0, 2.0), (0.25, 2.0), (0.5, 0.0), (1.0, 3.0))
    df = spark.range(0, 101).selectExpr("id / 100.0D AS q", "0 AS place")
    total = 0.5 + 0.25 + 0.75
    for r in df.select("q", C.positions(df.q, [knots], df.place).alias("t")).collect():
        steps = [(i + 0.5) / 20000 for i in range(int(round(r.t * 20000)))]
        weight = lambda t: 2 if t < 0.25 else 2 - 8 * (t - 0.25) if t < 0.5 else 6 * (t - 0.5)
        assert sum(map(weight, steps)) / 20000 / total == pytest.approx(r.q, abs=1e-3)


def test_edges(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, "x", None), (3, "x", None), (None, "y z", ""), (None, "y z", ""), (9, "w " * 400_000, "b")]
    got = C.mixed(docs_of(spark, rows)).collect()
    assert sorted((r.size, r.source_size, r.taken) for r in got if r.source == "a") == [(0, 0, 0), (0, 0, 0)]
    assert sum(r.taken for r in got) == pytest.approx(1.5 * 400_006, abs=4) and len(got) == 7
    assert C.mixed(docs_of(spark, rows[:2])).select("taken").distinct().collect() == [(0,)]
    assert C.by_position(C.mixed(docs_of(spark, rows[:2]))).select("position").distinct().collect() == [(None,)]
    assert C.mixed(docs_of(spark, rows).limit(0)).count() == 0
