"""Clustering: the walk over both trees against all distances, trees hold what they promise, rounds against a plain version."""

import hashlib
import math

import numpy as np
import pytest

from marlstone.llm import centroids as C


def points_of(rng, kind, n):
    if kind == "clumps":
        return (rng.integers(-300, 300, (5, 64))[rng.integers(0, 5, n)] + rng.integers(-3, 4, (n, 64))).astype(np.int64)
    if kind == "copies":
        return np.repeat(rng.integers(-9, 9, (2, 64)), [n - n // 4, n // 4], axis=0).astype(np.int64)
    if kind == "line":
        return np.outer(np.arange(n), np.eye(64, dtype=np.int64)[0])
    return rng.integers(-(2**26), 2**26 if kind == "huge" else 50, (n, 64)) if kind == "huge" else rng.integers(-20, 20, (n, 64))


def all_nearest(points, centroids):
    d = np.array([[sum((int(a) - int(b)) ** 2 for a, b in zip(p, c)) for c in centroids] for p in points], dtype=object)
    return np.array([min(range(len(centroids)), key=lambda k: (row[k], k)) for row in d])


@pytest.mark.parametrize("kind", ["clumps", "copies", "line", "plain", "huge"])
def test_walk_against_all_distances(kind):
    rng = np.random.default_rng(5)
    for n, k in [(1, 1), (40, 16), (400, 16), (300, 1)]:
        points = points_of(rng, kind, n)
        centroids = np.concatenate([points[:: max(1, n // k)][:k], points[:1]])  # the first comes twice: ties
        tree, over = C.Tree(points), C.Tree(centroids, 1)
        got, compared = C.nearest(points, tree, centroids, over)
        assert (got == all_nearest(points, centroids)).all() and compared > 0


def test_clumps_are_taken_whole():
    points = points_of(np.random.default_rng(1), "clumps", 1000)
    centroids = points[np.unique(points.round(-2), axis=0, return_index=True)[1]][:40]
    got, compared = C.nearest(points, C.Tree(points), centroids, C.Tree(centroids, 1))
    assert (got == C.squared(points, centroids).argmin(1)).all() and compared < 0.7 * points.shape[0] * len(centroids)


@pytest.mark.parametrize("kind", ["clumps", "copies", "line", "plain"])
def test_tree(kind):
    points = points_of(np.random.default_rng(2), kind, 500)
    t = C.Tree(points)
    assert sorted(t.order) == list(range(500))
    for i in range(len(t.centre)):
        below = t.order[t.first[i] : t.last[i]]
        far = np.sqrt(((points[below] - points[t.centre[i]]) ** 2).sum(1))
        assert t.centre[i] in below and far.max() <= t.radius[i] * (1 + 1e-9)
        kids = range(t.child[i], t.child[i] + t.children[i])
        if t.children[i]:
            assert [t.first[k] for k in kids] + [t.last[i]] == [t.first[i]] + [t.last[k] for k in kids]
            centres = points[t.centre[list(kids)]]
            apart = np.sqrt(C.squared(centres, centres).astype(float)) + np.eye(len(centres)) * 1e18
            assert apart.min() > t.radius[i] / 2 * (1 - 1e-9) and all(t.radius[k] <= t.radius[i] / 2 * (1 + 1e-9) for k in kids)
        else:
            assert len(below) <= C.LEAF or t.radius[i] == 0


def plain(rows, k=16, rounds=3):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda r: (hashlib.sha256(f"1:{'null' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    centroids = [v for _, v in sorted(kept, key=key)[:k]]
    gap = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    near = lambda v: min((gap(v, c), n) for n, c in enumerate(centroids))
    for _ in range(rounds):
        of = [near(v)[1] for _, v in kept]
        for n in set(of):
            own = [v for (_, v), o in zip(kept, of) if o == n]
            centroids[n] = [sum(c) // len(own) for c in zip(*own)]
    out = [(i, *near(v)[::-1]) for i, v in kept]
    sums = {n: sum(d for _, c, d in out if c == n) for n in {c for _, c, _ in out}}
    return sorted([(i, c, d, sums[c], sum(sums.values()), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for i, c, d in out], key=repr)


SCHEMA = "vec_id long, embedding array<float>, cluster int, v string, n int"


def run(spark, rows, parts):
    df = spark.createDataFrame([(i, v, 0, "v", 0) for i, v in rows], SCHEMA).repartition(parts)
    return sorted(map(tuple, C.clusters(df).collect()), key=repr)


def test_rounds_against_a_plain_version(spark):
    rng = np.random.default_rng(9)
    rows = [(k, rng.normal(k % 7, 0.3, 64).astype(np.float32).tolist()) for k in range(300)] + [(k, [0.5] * 64) for k in range(300, 460)]
    assert run(spark, rows, 5) == plain(rows)


def test_edges(spark):
    nan, good = float("nan"), [0.25] * 64
    rows = [(1, good), (1, good), (None, [-0.01] * 64), (2, None), (3, []), (4, good[:63]), (5, good + [1.0]), (6, [None] + good[1:]), (7, [nan] + good[1:]), (8, [float("inf")] + good[1:]), (9, [-0.0] * 64)]
    got = run(spark, rows, 3)
    assert got == plain(rows) and len(got) == 4
    assert run(spark, rows[3:10], 2) == [] and run(spark, [], 1) == []
    huge = run(spark, [(1, [3e38] * 64), (2, [-3e38] * 64), (3, [3e38] + [0.0] * 63)], 1)
    assert [r[2] for r in huge] == [0, 0, 0]


def test_leaves_whose_pairs_wait_are_not_taken_whole():
    for seed in (98, 206, 314):
        rng = np.random.default_rng(seed)
        n = int(rng.integers(2, 400))
        k = int(min(n, rng.integers(2, 17)))
        points = np.zeros((n, 64), np.int64)
        points[:, :2] = rng.integers(-50, 50, (n, 2))
        centroids = points[rng.permutation(n)[:k]]
        got, _ = C.nearest(points, C.Tree(points), centroids, C.Tree(centroids, 1))
        assert (got == all_nearest(points, centroids)).all()


@pytest.mark.parametrize("high", [1e7, 1e20, 1e160, 1.7e308])
def test_walk_over_wide_vectors(high):
    rng = np.random.default_rng(3)
    v = np.concatenate([rng.normal(0, 1, (60, 64)), rng.choice([-1, 0, 1], (60, 64)) * high, rng.normal(0, high / 9, (20, 64))])
    points, narrow = C.whole(v, 64), C.whole(np.floor(v[:60] * 64) / 64, 64)
    assert points.dtype == object and narrow.dtype == np.int64 and points[70].tolist() == [int(x) * 64 for x in v[70]]
    centroids = points[[0, 5, 70, 70, 90, 130]]
    over = C.Tree(centroids, 1)
    for p in (points, narrow):
        got, _ = C.nearest(p, C.Tree(p), centroids, over)
        assert (got == all_nearest(p, centroids)).all()


def fitting(rows):
    return [tuple(None if isinstance(x, int) and x >= 2**63 else x for x in r) for r in rows]


def test_large_components_count_as_they_are(spark):
    rng = np.random.default_rng(4)
    rows = [(k, rng.normal(0, 1, 64).astype(np.float32).tolist()) for k in range(60)]
    rows += [(k, [float(np.float32(1.5e6 + 3e5 * (k % 3)))] + rng.normal(0, 1, 63).astype(np.float32).tolist()) for k in range(60, 90)]
    expected = plain(rows)
    assert run(spark, rows, 3) == expected == fitting(expected)
    rows += [(k, [float(np.float32((k % 5 - 2) * 10.0 ** (6 + k % 33)))] * 64) for k in range(90, 420)]
    assert run(spark, rows, 3) == sorted(fitting(plain(rows)), key=repr)
