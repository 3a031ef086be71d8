"""Lloyd's clustering of vectors by a dual-tree walk, in integers.

Kept are vectors of the wanted length without null or non-finite components; a component x becomes floor(64 x). First all tasks cut their vectors into blocks of at most BLOCK, build a cover tree over each
and store it: nodes in order of depth, each with a centre (one of its vectors), a radius that covers all vectors below it, and a run of the block's order. Sibling centres are more than half the parent's radius apart, and
each vector below lies within half of it of its own centre.

A round builds the same kind of tree over the centroids (their number is a parameter) and walks both trees at once, all pairs of nodes of one depth together: a pair is dropped when its least possible distance is greater than
the greatest possible one to some centroid. Nodes left with one centroid take it as a whole, without looking at their vectors, unless pairs of theirs wait to be compared; leaf pairs are compared exactly. Bounds have some slack for rounding, so that
ties are never dropped, and the lesser number wins them. Tasks give out sums by cluster and component, which Spark adds up; the driver sees k times the number of components of them and divides exactly.

Vectors whose squared distances could outgrow a long are wide: they come in smaller blocks of their own, and their trees, walks and sums are made of Python's integers, as are walks to wide centroids. Their sums are passed on in
digits of DIGIT bits, which Spark adds up like the others.

Defined cases: null vectors and those of other lengths, with null, NaN or infinite components are left out; all finite components count as they are; a distance, or sum of distances, that doesn't fit into a long is null; -0.0 is 0;
repeated rows are vectors of their own; a null id is hashed as 'null'; ties of that hash are broken by the vector; with fewer vectors than k there are as many centroids as vectors; an empty table gives no rows;
further columns are left out.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import small_batches, stored

SIZE, K, ROUNDS, SCALE, SEED = 64, 16, 3, 64, "1:"
BLOCK, WIDE_BLOCK, LEAF = 1024, 128, 12
SLACK = 1e-9
#: Sums of squares of integers below this are exact in doubles for up to 512 components.
EXACT = 1 << 21
#: Doubles below this have all their integers and what floor needs to find them.
FINE = float(1 << 52)
MOST, DIGIT = (1 << 63) - 1, 32

TREES = "ids binary, known binary, wide boolean, vectors binary, centre binary, radius binary, first binary, last binary, child binary, children binary"


def kept(vectors: DataFrame, size: int = SIZE, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v) of the vectors that count. Components of v are doubles, cut so that they are in the order of the integers that whole() makes of them."""
    x = F.col(f"`{vector_col}`").cast("array<double>")
    sound = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    cut = F.transform(x, lambda e: F.when(F.abs(e) < FINE / scale, F.floor(e * scale) / F.lit(float(scale))).otherwise(e))
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.when((F.size(x) == size) & sound, cut).alias("v"))
    return rows.filter("v is not null")


def narrow_below(size: int) -> int:
    """Squared distances of vectors of integers below this fit into a long."""
    return math.isqrt((1 << 62) // max(1, size)) // 2


def whole(v: np.ndarray, scale: int) -> np.ndarray:
    """Integers of kept components: longs, or Python's where a vector is wide."""
    if (np.abs(v) < narrow_below(v.shape[1]) / scale).all():
        return np.rint(v * scale).astype(np.int64)
    each = lambda e: round(e * scale) if abs(e) < FINE / scale else (r := e.as_integer_ratio())[0] * scale // r[1]
    return integers([[each(e) for e in row] for row in v.tolist()], v.shape[1])


def integers(rows: list[list[int]], size: int) -> np.ndarray:
    """A matrix of longs, or of Python's integers where a row is wide."""
    wide = any(abs(e) >= narrow_below(size) for row in rows for e in row)
    return np.array(rows, object if wide else np.int64).reshape(-1, size)


def root(d: np.ndarray) -> np.ndarray:
    """Square roots as doubles; infinite beyond these."""
    if d.dtype != object:
        return np.sqrt(d.astype(np.float64))
    one = lambda n: math.sqrt(n) if n.bit_length() < 1000 else float(math.isqrt(n)) if n.bit_length() < 2040 else math.inf
    return np.array([one(n) for n in d.ravel().tolist()], np.float64).reshape(d.shape)


class Tree:
    """A cover tree over the rows of an integer matrix. order: the rows, so that those below node i are order[first[i]:last[i]]; child and children: place and number of its child nodes (0: a leaf)."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        far = root(squared(points, points))
        self.order = np.arange(len(points))
        nodes = [[0, float(far[0].max()) if len(points) else 0.0, 0, len(points), 0, 0]]
        k = 0
        while k < len(nodes):
            centre, radius, first, last, _, _ = nodes[k]
            rows = self.order[first:last]
            if len(rows) > leaf and 0 < radius < math.inf:
                # the net: the centre, then whatever no member of the net has within half the radius yet
                near, free, own = far[centre, rows], np.ones(len(rows), bool), np.full(len(rows), -1)
                members = []
                while True:
                    take = free & (near <= radius / 2)
                    own[take] = len(members)
                    members.append((centre, float(near[take].max())))
                    free &= ~take
                    if not free.any():
                        break
                    centre = rows[np.argmax(free)]
                    near = far[centre, rows]
                self.order[first:last] = rows[np.argsort(own, kind="stable")]
                ends = first + np.cumsum(np.bincount(own, minlength=len(members)))
                nodes[k][4:] = [len(nodes), len(members)]
                for (c, r), end, start in zip(members, ends, [first, *ends[:-1]]):
                    nodes.append([c, r, int(start), int(end), 0, 0])
            k += 1
        self.centre, self.first, self.last, self.child, self.children = (np.array([n[i] for n in nodes], np.int64) for i in (0, 2, 3, 4, 5))
        self.radius = np.array([n[1] for n in nodes])


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of a to all rows of b."""
    if a.dtype == b.dtype == np.int64 and a.shape[1] <= 512 and max(np.abs(a).max(initial=0), np.abs(b).max(initial=0)) < EXACT:
        x, y = a.astype(np.float64), b.astype(np.float64)
        return (np.einsum("ij,ij->i", x, x)[:, None] + np.einsum("ij,ij->i", y, y)[None, :] - 2 * (x @ y.T)).astype(np.int64)
    return np.stack([((a - c) ** 2).sum(1) for c in b], 1)


def _stays(d: np.ndarray, radius: np.ndarray, other: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Whether the least possible distance is not greater than least; the slack is in proportion to all that was rounded, and what is infinite stays."""
    with np.errstate(invalid="ignore"):
        return ~(d - radius - other > least + SLACK * (1 + d + radius + other + least))


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1, ... (counts[i] of them) for each i, one after the other."""
    return np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())


def nearest(points: np.ndarray, tree, centroids: np.ndarray, over: Tree) -> tuple[np.ndarray, int]:
    """(the nearest centroid of each point, the lesser number of equal ones; how many distances were worked out, of node pairs and of points)."""
    out, compared = np.full(len(points), -1), 0
    open_leaf: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    q, c, least = np.zeros(1, np.int64), np.zeros(1, np.int64), np.full(len(tree.centre), np.inf)
    waits = np.zeros(len(tree.centre), bool)  # leaves with pairs set aside
    while len(q):
        gap = points[tree.centre[q]] - centroids[over.centre[c]]
        d = root(np.einsum("ij,ij->i", gap, gap) if gap.dtype != object else (gap * gap).sum(1))
        compared += len(q)
        np.minimum.at(least, q, d + tree.radius[q])
        stays = _stays(d, tree.radius[q], over.radius[c], least[q])
        q, c, d = q[stays], c[stays], d[stays]
        left = np.bincount(q, minlength=len(tree.centre))
        alone = (left[q] == 1) & ~waits[q] & (over.last[c] - over.first[c] == 1)
        for node, centroid in zip(q[alone], over.order[over.first[c[alone]]]):
            out[tree.order[tree.first[node] : tree.last[node]]] = centroid
        q, c, d = q[~alone], c[~alone], d[~alone]
        both = (tree.children[q] == 0) & (over.children[c] == 0)
        open_leaf.append((q[both], c[both], d[both]))
        waits[q[both]] = True
        q, c = q[~both], c[~both]
        # a pair gives the pairs of its children; a leaf stands for itself
        nq, nc = np.maximum(tree.children[q], 1), np.maximum(over.children[c], 1)
        sq, sc = np.where(tree.children[q] > 0, tree.child[q], q), np.where(over.children[c] > 0, over.child[c], c)
        above = np.repeat(least[q], nq)
        q, c, nc = _spread(sq, nq), np.repeat(sc, nq), np.repeat(nc, nq)
        np.minimum.at(least, q, above)
        q, c = np.repeat(q, nc), _spread(c, nc)
    q, c, d = (np.concatenate(parts) for parts in zip(*open_leaf))
    if len(q):
        # a bound that fell after a leaf pair was set aside drops it now
        stays = _stays(d, tree.radius[q], over.radius[c], least[q])
        q, c = q[stays], c[stays]
        wanted = np.zeros((len(centroids), len(tree.centre)), bool)
        n = over.last[c] - over.first[c]
        wanted[over.order[_spread(over.first[c], n)], np.repeat(q, n)] = True
        best = np.full(len(points), MOST) if points.dtype == centroids.dtype == np.int64 else np.full(len(points), math.inf, object)
        for number in np.flatnonzero(wanted.any(1)):
            nodes = np.flatnonzero(wanted[number])
            rows = tree.order[_spread(tree.first[nodes], tree.last[nodes] - tree.first[nodes])]
            d = squared(points[rows], centroids[number : number + 1])[:, 0]
            nearer = (d < best[rows]).astype(bool)
            best[rows[nearer]], out[rows[nearer]] = d[nearer], number
            compared += len(rows)
    return out, compared


class _Stored:
    """A block's tree as read back."""

    def __init__(self, row: dict, size: int):
        longs = lambda name: np.frombuffer(row[name], np.int64)
        self.ids, self.known = longs("ids"), np.frombuffer(row["known"], bool)
        self.points = (np.array([int(x) for x in row["vectors"].split(b",")], object) if row["wide"] else longs("vectors")).reshape(-1, size)
        self.centre, self.first, self.last, self.child, self.children = (longs(n) for n in ("centre", "first", "last", "child", "children"))
        self.radius, self.order = np.frombuffer(row["radius"], np.float64), np.arange(len(self.ids))


def trees(vectors: DataFrame, size: int = SIZE, scale: int = SCALE) -> DataFrame:
    """A row for each block of kept vectors: the block in the order of its tree, and the tree."""

    def block(ids: pa.Array, points: np.ndarray) -> pa.RecordBatch:
        tree, wide = Tree(points), points.dtype == object
        ids = ids.take(pa.array(tree.order))
        place = np.empty(len(points), np.int64)
        place[tree.order] = np.arange(len(points))
        points = points[tree.order]
        said = ",".join(map(str, points.ravel().tolist())).encode() if wide else points.tobytes()
        columns = [c.tobytes() for c in (ids.fill_null(0).to_numpy().astype(np.int64), ids.is_valid().to_numpy(zero_copy_only=False), place[tree.centre], tree.radius, tree.first, tree.last, tree.child, tree.children)]
        return pa.RecordBatch.from_arrays([pa.array([c]) for c in (*columns[:2], wide, said, *columns[2:])], names=[f.split()[0] for f in TREES.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[pa.Array, np.ndarray]]] = {BLOCK: [], WIDE_BLOCK: []}

        def blocks(most: int, least: int):
            count = sum(len(h[0]) for h in held[most])
            if count < least:
                return
            ids, points = pa.chunked_array([h[0] for h in held[most]]).combine_chunks(), np.concatenate([h[1] for h in held[most]])
            done = 0
            while count - done >= least:
                take = min(most, count - done)
                yield block(ids.slice(done, take), whole(points[done : done + take], scale))
                done += take
            held[most] = [(ids.slice(done), points[done:])] if done < count else []

        for batch in batches:
            if batch.num_rows:
                v = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
                narrow = (np.abs(v) < narrow_below(size) / scale).all(1)
                for most, rows in ((BLOCK, narrow), (WIDE_BLOCK, ~narrow)):
                    if rows.any():
                        held[most].append((batch.column(0).filter(pa.array(rows)), v[rows]))
                        yield from blocks(most, most)
        for most in held:
            yield from blocks(most, 1)

    small_batches(vectors.sparkSession)
    return stored(vectors.mapInArrow(run, TREES), "trees")


def _over_blocks(stored_trees: DataFrame, centroids: np.ndarray, give, schema: str) -> DataFrame:
    size = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        over = Tree(centroids, 1)
        for batch in batches:
            for row in batch.to_pylist():
                block = _Stored(row, size)
                yield give(block, nearest(block.points, block, centroids, over)[0])

    return stored_trees.mapInArrow(run, schema)


def moved(stored_trees: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round."""
    k, size = centroids.shape

    def give(block: _Stored, of: np.ndarray) -> pa.RecordBatch:
        there = np.flatnonzero(np.bincount(of, minlength=k))
        sums = np.concatenate([np.append(block.points[of == c].sum(0), (of == c).sum()) for c in there])
        clusters, at = np.repeat(there, size + 1), np.tile(np.arange(size + 1), len(there))
        if sums.dtype != object:
            digit = np.zeros(len(sums), np.int64)
        else:
            digits = [(place, (x, -x)[x < 0] >> DIGIT * place & (1 << DIGIT) - 1, (1, -1)[x < 0], n) for n, x in enumerate(sums.tolist()) for place in range(max(1, -(-x.bit_length() // DIGIT)))]
            digit, sums = np.array([d[0] for d in digits]), np.array([d[1] * d[2] for d in digits])
            clusters, at = (x[[d[3] for d in digits]] for x in (clusters, at))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (clusters, at, digit, sums)], names=["cluster", "at", "digit", "total"])

    sums = _over_blocks(stored_trees, centroids, give, "cluster long, at long, digit long, total long").groupBy("cluster", "at", "digit").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    totals: Counter[tuple[int, int]] = Counter()
    for r in sums.collect():
        totals[r.cluster, r.at] += int(r.total) << DIGIT * r.digit
    new = centroids.tolist()
    for c in {c for c, _ in totals}:
        new[c] = [totals[c, i] // totals[c, size] for i in range(size)]
    return integers(new, size)


def clusters(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, seed: str = SEED, size: int = SIZE, scale: int = SCALE, **columns: str) -> DataFrame:
    """One row per vector that counts: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    rows = kept(vectors, size, scale, **columns)
    start = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))), 256)
    first = [r.v for r in rows.orderBy(start, "v").limit(k).collect()]
    if not first:
        return vectors.sparkSession.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    centroids = whole(np.array(first, np.float64), scale)
    held = trees(rows, size, scale)
    for _ in range(rounds):
        centroids = moved(held, centroids)

    def give(block: _Stored, of: np.ndarray) -> pa.RecordBatch:
        gap = block.points - centroids[of]
        ids = pa.array(block.ids, mask=~block.known)
        distance = pa.array([d if d <= MOST else None for d in (gap * gap).sum(1).tolist()], pa.int64())
        return pa.RecordBatch.from_arrays([ids, pa.array(of.astype(np.int32)), distance], names=["vec_id", "cluster", "distance"])

    found = stored(_over_blocks(held, centroids, give, "vec_id long, cluster int, distance long"), "clustered")
    total = F.when(F.count("distance") == F.count("*"), F.sum(F.col("distance").cast("decimal(38,0)")))
    by = {r.cluster: None if r.total is None else int(r.total) for r in found.groupBy("cluster").agg(total.alias("total")).collect()}
    inertia = None if None in by.values() else sum(by.values())
    fits = lambda n: None if n is None or n > MOST else n
    digest = {c: hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest() for c in by}
    facts = vectors.sparkSession.createDataFrame([(c, fits(n), fits(inertia), digest[c]) for c, n in by.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
