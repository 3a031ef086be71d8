"""Near-duplicates by ProbMinHash signatures of five-word shingles, banding and exact verification.

Each different shingle of a document has a Poisson process, whose arrivals fall on random components of the signature; a component keeps the shingle that arrives first. A shingle is left as soon as its arrivals come later than
the latest of all components (early termination). Components of two documents agree with the probability Jaccard of their weighted shingles.
All shingles weigh the same, however often they occur, so that this is the Jaccard of the sets, which is what a link is defined by.

Documents with the same words are one node. Nodes that agree on all ROWS components of one of BANDS bands are candidates. Groups in
a bucket are never paired out: each member is checked against one pivot; those outside its component against PIVOTS members of it, which differ from bucket to
bucket; and all against a pivot outside it. Members that are still apart in a bucket are joined exactly by prefixes of their rarest shingles. A link is a Jaccard of
the sets of shingles of at least SIMILARITY, found from the whole texts. At a similarity of 0.8 no band of the 32 agrees with
probability 5e-8. Classes are the connected components.

Words: runs of ASCII letters and digits and of other characters than ASCII, A-Z in lower case. Defined cases: null text counts as empty; a text of one to four words
is one shingle; texts without words are alike only if equal; of equal doc_ids all rows get their class; ties can't occur, as
the least doc_id stands for a class; an empty table gives no rows; further columns are left out of `classes` and kept by `drop_near_copies`.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bloom
from .components import components
from .decontaminate import words_of
from .shared import arrow_map, fresh, least_of_most, stored

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 32, 4
PIVOTS = 4
COMPONENTS = BANDS * ROWS
REMEMBERED = 120_000
FREQUENT = 250_000  # shingles whose counts go to every task: 4 MB

# Odd multipliers; any would do.
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < REMEMBERED and len(word) <= 64:
            self[word] = h
        return h


def shingles(words: list[bytes], hashes: WordHashes, size: int = SHINGLE) -> np.ndarray:
    """Hashes of all runs of size words, repeated as they occur; of all words if they are fewer."""
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = min(size, len(words))
    out = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        out += h[k : len(words) - n + 1 + k] * FACTORS[k]
    return mixed(out + np.uint64(n))


def signature(ids: np.ndarray, weights: np.ndarray, size: int = COMPONENTS) -> np.ndarray:
    """For each component, the id of the element that arrives first there."""
    first, who = np.full(size, np.inf), np.zeros(size, np.uint64)
    at, turn, latest = np.zeros(len(ids)), 0, np.inf
    with np.errstate(over="ignore"):
        while len(ids):
            times = max(1, min(64, 768 // len(ids)))
            draw = mixed(ids[:, None] + np.arange(turn + 1, turn + times + 1, dtype=np.uint64)[None, :] * FACTORS[0])
            gap = -np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weights[:, None]
            when = at[:, None] + np.cumsum(gap, axis=1)
            turn += times
            live = when < latest
            t, slot = when[live], (mixed(draw[live]) % np.uint64(size)).astype(np.int64)
            element = np.broadcast_to(ids[:, None], when.shape)[live]
            order = np.argsort(-t, kind="stable")  # written last, the earliest stays
            best, name = np.full(size, np.inf), np.zeros(size, np.uint64)
            best[slot[order]], name[slot[order]] = t[order], element[order]
            sooner = best < first
            first[sooner], who[sooner] = best[sooner], name[sooner]
            latest = first.max()
            go_on = when[:, -1] < latest
            ids, weights, at = ids[go_on], weights[go_on], when[go_on, -1]
    return who


def band_hashes(who: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        rows = who.reshape(BANDS, ROWS) * FACTORS[:ROWS][None, :]
        return mixed(rows.sum(axis=1, dtype=np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64) * FACTORS[5]).view(np.int64)


def node_of(text: str, words: list[bytes]) -> bytes:
    """16 bytes that stand for the words in order; for the text itself if it has none."""
    return xxhash.xxh3_128_digest(b" ".join(words) if words else b"\x00" + text.encode())


def signed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, key, node, size (different shingles) and bands (null without words) of each row."""

    def make() -> Callable:
        hashes = WordHashes()

        def one(batch):
            nodes, sizes, bands = [], [], []
            for text in batch.column(1).to_pylist():
                words = words_of(text)
                nodes.append(node_of(text or "", words))
                ids = np.unique(shingles(words, hashes))
                sizes.append(len(ids))
                bands.append(band_hashes(signature(ids, np.ones(len(ids)))) if len(ids) else None)
            cols = [batch.column(0), batch.column(2), pa.array(nodes, pa.binary()), pa.array(sizes, pa.int64()), pa.array(bands, pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays(cols, names=["doc_id", "key", "node", "size", "bands"])

        return one

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), _key(id_col, text_col).alias("key"))
    return arrow_map(rows, make, "doc_id long, key string, node binary, size long, bands array<long>")


def shingled(docs: DataFrame) -> DataFrame:
    """node and its different shingles in order, as bytes, from doc_id and text."""

    def make() -> Callable:
        hashes = WordHashes()

        def one(batch):
            nodes, sets = [], []
            for text in batch.column(0).to_pylist():
                words = words_of(text)
                nodes.append(node_of(text or "", words))
                sets.append(np.unique(shingles(words, hashes)).tobytes())
            return pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(sets, pa.binary())], names=["node", "shingles"])

        return one

    return arrow_map(docs.select("text"), make, "node binary, shingles binary")


def jaccard(a: bytes, b: bytes) -> float:
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if len(x) > len(y):
        x, y = y, x
    if not len(x):
        return 0.0
    both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
    return both / (len(x) + len(y) - both)


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (u, v) whose Jaccard is similarity or more."""
    full = pairs.join(sets.select(F.col("node").alias("u"), F.col("shingles").alias("a")), "u")
    full = full.join(sets.select(F.col("node").alias("v"), F.col("shingles").alias("b")), "v").select("u", "v", "a", "b")

    def make() -> Callable:
        def one(batch):
            good = [jaccard(a, b) >= similarity for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            return batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

        return one

    return arrow_map(full, make, "u binary, v binary")


def _in_range(similarity: float):
    """Sets whose sizes differ by more can't be so similar."""
    return F.least("u_size", "v_size") >= F.lit(similarity) * F.greatest("u_size", "v_size") - 1e-9


def _against_pivots(members: DataFrame, pivots: DataFrame, similarity: float, also: Column | None = None) -> DataFrame:
    """members: bucket, node, size; pivots: bucket, v, v_size, a few for each bucket. Pairs in order, once each, for which `also` holds.

    One join of stored tables by bucket: Spark can split a hot one, as nothing else in the stage needs its rows together."""
    met = members.withColumnsRenamed({"node": "u", "size": "u_size"}).join(pivots, "bucket")
    met = met.filter((F.col("u") != F.col("v")) & _in_range(similarity) & (F.lit(True) if also is None else also))
    return met.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    return rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _split(rows: DataFrame) -> DataFrame:
    """The buckets whose members have several labels, as a stored table: a join with it deals out both sides anew, so that Spark can split a hot bucket."""
    return stored(rows.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high").select("bucket"), "split")


def links(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str, similarity: float) -> DataFrame | None:
    """nodes: node, doc_id, size, bands. Edges (u, v) whose components are the classes, or None if no two nodes share a bucket."""
    banded = nodes.filter("bands is not null").select("node", "size", F.explode("bands").alias("bucket"))
    # the bucket's least node is its first pivot
    shared = stored(
        banded.groupBy("bucket").agg(F.min(F.struct("node", "size")).alias("p"), F.count("*").alias("n")).filter("n > 1")
        .select("bucket", F.col("p.node").alias("v"), F.col("p.size").alias("v_size")), "buckets",
    )
    members = stored(banded.join(shared.select("bucket"), "bucket"), "members")
    if members.isEmpty():
        return None
    wanted = stored(nodes.select("node", "doc_id").join(members.select("node").distinct(), "node", "left_semi"), "wanted")
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    # shingles of the nodes in shared buckets only; their texts alone are read again and moved
    found = shingled(bloom.only(texts.filter("doc_id is not null"), "doc_id", wanted.filter("doc_id is not null"), "doc_id", wanted.count()))
    if not wanted.filter("doc_id is null").isEmpty():
        found = found.union(shingled(texts.filter("doc_id is null")))
    sets = stored(found.join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"]), "shingles")

    edges = stored(verified(_against_pivots(members, shared, similarity), sets, similarity), "links")
    labels = components(edges)
    # buckets whose members aren't in one component yet
    apart = _labelled(members, labels)
    apart = stored(apart.join(_split(apart), "bucket"), "apart")
    if apart.isEmpty():
        return edges
    first = shared.join(labels.withColumnRenamed("node", "v"), "v", "left").select("bucket", F.coalesce("label", "v").alias("first"))
    apart = stored(apart.join(first, "bucket"), "apart")
    outside = apart.filter("label <> first")
    # some members of the first pivot's component, others in each bucket, for those outside it
    inside = apart.filter("label = first").groupBy("bucket").agg(*[F.min_by(F.struct("node", "size"), F.xxhash64("bucket", "node", F.lit(k))).alias(f"p{k}") for k in range(PIVOTS)])
    inside = inside.select("bucket", F.explode(F.array_distinct(F.array(*[f"p{k}" for k in range(PIVOTS)]))).alias("p"))
    inside = stored(inside.select("bucket", F.col("p.node").alias("v"), F.col("p.size").alias("v_size")), "pivots")
    # and one outside for all the others
    second = stored(
        outside.groupBy("bucket").agg(F.max(F.struct("node", "size", "label")).alias("p"))
        .select("bucket", F.col("p.node").alias("v"), F.col("p.size").alias("v_size"), F.col("p.label").alias("second")), "pivots",
    )
    others = _against_pivots(apart, second, similarity, F.col("label") != F.col("second"))
    pairs = _against_pivots(outside, inside, similarity).union(others).distinct()
    edges = stored(edges.union(verified(pairs, sets, similarity)), "links")
    apart = apart.drop("first")
    labels = components(edges)
    # what is still apart in a bucket is joined exactly
    apart = _labelled(apart.drop("label"), labels)
    apart = apart.join(_split(apart), "bucket").select("node", "size", "label").distinct()
    apart = stored(apart.join(sets, "node"), "apart")
    if apart.isEmpty():
        return edges
    return stored(edges.union(verified(by_prefixes(apart, similarity), sets, similarity)), "links")


def frequent_shingles(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """At most FREQUENT shingles in order, those in most of the rows, and their counts."""

    def make() -> Callable:
        def one(batch):
            all_of = np.concatenate([np.frombuffer(x, np.uint64) for x in batch.column(0).to_pylist()])
            s, n = np.unique(all_of, return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(s.view(np.int64)), pa.array(n, pa.int64())], names=["shingle", "n"])

        return one

    counts = stored(arrow_map(rows.select("shingles"), make, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")).filter("n > 2"), "frequent")
    got = counts.filter(F.col("n") >= least_of_most(counts, "n", FREQUENT)).toArrow()
    s, n = got.column("shingle").to_numpy().view(np.uint64), got.column("n").to_numpy()
    order = np.argsort(s)
    return s[order], n[order]


def by_prefixes(rows: DataFrame, similarity: float) -> DataFrame:
    """rows: node, size, label, shingles. Pairs (u, v) of different labels that may be so similar, none left out.

    All sets are put in one order, rare shingles first. Of n shingles the first n - ceil(similarity * n) + 1 are the prefix; two sets as similar as that
    share a shingle of their prefixes. Shingles of passages that many documents share come last and so bring hardly any pairs together.
    Of a pair, the shorter set's first shared shingle is among its first n - ceil(2 * similarity / (1 + similarity) * n) + 1, and what follows the first shared shingle
    in both must be enough for the overlap that the similarity asks for; pairs that fail this at all shared shingles are left out in the join itself.
    """
    overlap = similarity / (1 + similarity)  # of the sum of both sizes
    shipped = rows.sparkSession.sparkContext.broadcast(frequent_shingles(rows))

    def make() -> Callable:
        known, counts = shipped.value

        def one(batch):
            taken, prefix, place = [], [], []
            for k, x in enumerate(batch.column(3).to_pylist()):
                s = np.frombuffer(x, np.uint64)
                n = np.zeros(len(s), np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                    n = np.where(known[at] == s, counts[at], 0)
                # similarity * n is rounded down a little, so that no set just at the bound is missed
                most = len(s) - int(np.ceil(similarity * len(s) - 1e-9)) + 1
                first = s[np.lexsort((s, n))[:most]]
                prefix.append(first.view(np.int64))
                taken.append(np.full(len(first), k))
                place.append(np.arange(len(first)))
            which = pa.array(np.concatenate(taken))
            cols = [batch.column(k).take(which) for k in range(3)]
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(prefix)), pa.array(np.concatenate(place)), *cols], names=["shingle", "place", "node", "size", "label"])

        return one

    placed = arrow_map(rows.select("node", "size", "label", "shingles"), make, "shingle long, place long, node binary, size long, label binary")
    placed = stored(placed, "prefixes")
    mixed_ones = stored(placed.groupBy("shingle").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high").select("shingle"), "split")
    placed = stored(placed.join(mixed_ones, "shingle"), "prefixes")
    left = placed.filter(F.col("place") <= F.col("size") - F.lit(2 * overlap) * F.col("size") + 1e-9)
    left = left.select("shingle", F.col("place").alias("i"), F.col("node").alias("u"), F.col("size").alias("u_size"), F.col("label").alias("u_label"))
    right = placed.select("shingle", F.col("place").alias("j"), F.col("node").alias("v"), F.col("size").alias("v_size"), F.col("label").alias("v_label"))
    shorter = (F.col("u_size") < F.col("v_size")) | ((F.col("u_size") == F.col("v_size")) & (F.col("u") < F.col("v")))
    enough = F.least(F.col("u_size") - F.col("i"), F.col("v_size") - F.col("j")) >= F.lit(overlap) * (F.col("u_size") + F.col("v_size")) - 1e-9
    found = left.join(right, "shingle").filter(shorter & enough & (F.col("u_label") != F.col("v_label")) & _in_range(similarity))
    return found.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def _key(id_col: str, text_col: str):
    """Stands for a row's id and text, nulls too."""
    return F.md5(F.concat_ws("|", F.coalesce(F.col(f"`{id_col}`").cast("long").cast("string"), F.lit("null")), F.coalesce(F.col(f"`{text_col}`"), F.lit(""))))


def _classed(docs: DataFrame, id_col: str, text_col: str, similarity: float) -> DataFrame:
    rows = stored(signed(docs, id_col, text_col), "signed")
    nodes = stored(rows.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"), F.first("size").alias("size"), F.first("bands").alias("bands")), "nodes")
    edges = links(docs, nodes, id_col, text_col, similarity)
    labelled = nodes.select("node", "doc_id", "n")
    labelled = labelled.withColumn("label", F.col("node")) if edges is None else _labelled(labelled, components(edges))
    # the least doc_id stands for the class, nulls last; the node tells rows of one doc_id apart
    heads = labelled.groupBy("label").agg(F.min("doc_id").alias("class_id"), F.sum("n").alias("class_size"), F.min(F.struct(F.isnull("doc_id"), "doc_id", "node")).alias("head"))
    heads = heads.select("label", "class_id", "class_size", F.col("head.node").alias("head"))
    of_node = stored(labelled.select("node", "label").join(heads, "label").select("node", "class_id", "class_size", "head"), "classes")
    kept = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("node") == F.col("head"))
    return rows.select("doc_id", "key", "node").join(of_node, "node").select("doc_id", "key", "class_id", "class_size", kept.alias("kept"))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id (the least doc_id of the class), class_size and kept for each row of docs."""
    return _classed(docs, id_col, text_col, similarity).drop("key")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One document of each class, the one of least doc_id, with all columns; its rows of the same id and words stay together. Texts that stay are hardly moved."""
    gone = stored(_classed(docs, id_col, text_col, similarity).filter("not kept").select("key").distinct(), "gone")
    (row,) = fresh(docs, "_ms_row")
    return bloom.without(docs.withColumn(row, _key(id_col, text_col)), row, gone, "key", gone.count()).drop(row)
