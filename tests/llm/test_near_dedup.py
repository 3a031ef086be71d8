"""Classes against all pairs compared, and the estimate of the signature against the probability Jaccard."""

import random
from collections import Counter, defaultdict

import numpy as np

from marlstone.llm import near_dedup as N
from marlstone.llm.decontaminate import words_of


def brute_classes(rows):
    """rows: (doc_id, text). doc_id -> least doc_id of its class."""
    sets, groups = {}, defaultdict(list)
    for i, text in rows:
        words = words_of(text)
        n = min(5, len(words))
        sets[i] = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if words else {("", text or "")}
        for s in sets[i]:
            groups[s].append(i)
    head = {i: i for i in sets}

    def find(x):
        while head[x] != x:
            x = head[x]
        return x

    for i in sets:
        common = Counter(j for s in sets[i] for j in groups[s] if j < i)
        for j, c in common.items():
            if c / (len(sets[i]) + len(sets[j]) - c) >= 0.8 and find(i) != find(j):
                a, b = sorted((find(i), find(j)))
                head[b] = a
    return {i: find(i) for i in sets}


def test_signature_estimates_probability_jaccard():
    rng = np.random.default_rng(4)
    ids = rng.integers(0, 2**63, 400, dtype=np.uint64)
    weights = rng.integers(1, 6, 400).astype(float)
    for share in (0.5, 0.8, 0.95):
        n = int(400 * share)
        a, wa = ids[:n], weights[:n]
        b, wb = ids[400 - n :], weights[400 - n :]
        both = set(a.tolist()) & set(b.tolist())
        A, B = dict(zip(a.tolist(), wa, strict=True)), dict(zip(b.tolist(), wb, strict=True))
        exact = sum(1 / sum(max(A.get(y, 0) / A[x], B.get(y, 0) / B[x]) for y in {*A, *B}) for x in both)
        got = (N.signature(a, wa, 4096) == N.signature(b, wb, 4096)).mean()
        assert abs(got - exact) < 0.03
    assert len(N.signature(ids[:1], weights[:1])) == N.COMPONENTS


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = brute_classes([(r.doc_id, r.text) for r in docs.collect()])
    got = {r.doc_id: r.class_id for r in N.classes(docs).collect()}
    assert got == want and len(set(want.values())) < len(want)
    kept = N.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))


def test_chain_without_a_common_pivot(spark):
    """A chain of texts, each near the next one only, is one class."""
    rng = random.Random(2)
    words = [f"w{rng.randrange(10**6)}" for _ in range(1200)]
    rows = [(k, " ".join(words[10 * k : 10 * k + 200]), "x") for k in range(60)]
    rows += [(100 + k, " ".join(f"z{rng.randrange(10**6)}" for _ in range(80)), "x") for k in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, class_id string").repartition(4)
    got = {r.doc_id: r.class_id for r in N.classes(df).collect()}
    assert got == brute_classes([(a, b) for a, b, _ in rows])


def test_copies_that_repeat_a_line(spark):
    """However often a copy repeats a line, the Jaccard of the sets decides."""
    rng = random.Random(9)
    rows = []
    for k in range(12):
        text = " ".join(f"w{rng.randrange(10**6)}" for _ in range(104))
        line = " ".join(f"r{rng.randrange(10**6)}" for _ in range(20))
        rows += [(2 * k, text), (2 * k + 1, f"{text} {f'{line} ' * 300}")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in N.classes(df).collect()}
    assert got == brute_classes(rows) == {k: k - k % 2 for k in range(24)}


def test_rows_of_one_id_and_of_none(spark):
    """A row goes by its id and text together; a near copy without an id goes too."""
    rng = random.Random(5)
    text = " ".join(f"w{rng.randrange(10**6)}" for _ in range(200))
    rows = [(1, text), (2, text + " more"), (2, "a text of its own that stays"), (None, text + " again"), (None, "another one without an id")]
    kept = N.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=repr) == sorted([rows[0], rows[2], rows[4]], key=repr)


def test_edges(spark):
    rows = [(None, None, 1), (5, "", 1), (6, "!!", 1), (7, "One two", 1), (7, "one, TWO", 1), (9, "one two", 1), (8, "x " * 5000, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, node int")
    got = sorted(((r.doc_id, r.class_id, r.class_size) for r in N.classes(df).collect()), key=repr)
    assert got == sorted([(None, 5, 2), (5, 5, 2), (6, 6, 1), (7, 7, 3), (7, 7, 3), (9, 7, 3), (8, 8, 1)], key=repr)
    assert N.classes(df.limit(0)).count() == 0


def test_prefix_join_misses_nothing(spark):
    """All pairs of sets at or above the bound are among those the prefixes bring together."""
    rng = np.random.default_rng(6)
    common = rng.integers(0, 2**63, 60, dtype=np.uint64)
    sets = []
    for k in range(60):
        own = rng.integers(0, 2**63, 40, dtype=np.uint64)
        for j in range(4):
            part = np.concatenate([common[: rng.integers(20, 60)], own[: 40 - 3 * j]])
            sets.append((bytes([k, j]), np.unique(part)))
    rows = spark.createDataFrame([(n, len(s), n, s.tobytes()) for n, s in sets], "node binary, size long, label binary, shingles binary")
    got = {(bytes(r.u), bytes(r.v)) for r in N.by_prefixes(rows, 0.8).collect()}
    want = {(a, b) for a, x in sets for b, y in sets if a < b and N.jaccard(x.tobytes(), y.tobytes()) >= 0.8}
    assert want and want <= got
