"""Hits of the suffix automaton against a search for every window."""

import hashlib
import random

from marlstone.llm.decontaminate import SuffixAutomaton, clean, cut_out, judge, words_of


def brute(words, items, window=13):
    hit, found = set(), set()
    for i, item in items:
        n = min(window, len(item))
        if not n:
            continue
        for s in range(len(item) - n + 1):
            w = item[s : s + n]
            for k in range(len(words) - n + 1):
                if words[k : k + n] == w:
                    hit.update(range(k, k + n))
                    found.add(i)
    return hit, found


def test_against_brute_force():
    rng = random.Random(1)
    for trial in range(300):
        letters = "ab" if trial % 2 else "abcdef"
        items = [(k, [rng.choice(letters).encode() for _ in range(rng.choice([0, 1, 2, 3, 5, 9]))]) for k in range(6)]
        machine = SuffixAutomaton(items, 4)
        words = [rng.choice(letters + "z").encode() for _ in range(rng.randint(0, 40))]
        spans, found = machine.hits(words)
        want, who = brute(words, items, 4)
        assert {k for b, e in spans for k in range(b, e)} == want
        assert {machine.item_ids[k] for k in found} == who
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_query_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    items = [(r.item_id, words_of(r.text)) for r in bench.collect()]
    whole = {r.doc_id: r for r in judge(docs, bench).collect()}
    parts = {r.doc_id: r for r in judge(docs, bench, block_words=200).collect()}
    assert len(whole) == docs.count() and any(r.contaminated for r in whole.values())
    windows = {}
    for i, item in items:
        for s in range(max(1, len(item) - 12)):
            windows.setdefault(tuple(item[s : s + 13]), set()).add(i)
    for r in docs.collect():
        words, hit, found = words_of(r.text), set(), set()
        for k in range(len(words) - 12):
            if w := windows.get(tuple(words[k : k + 13])):
                hit.update(range(k, k + 13))
                found |= w
        got = whole[r.doc_id]
        sha = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        assert (got.n_words, got.n_hit, got.n_items, got.items_sha256) == (len(words), len(hit), len(found), sha)
        assert parts[r.doc_id] == got


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (3, "One, TWO three", "c"), (3, "One, TWO three", "c")], "doc_id long, text string, n_hit string")
    bench = spark.createDataFrame([("x", "one two"), ("y", None), ("z", "one two")], "item_id string, text string")
    got = sorted((r.doc_id, r.n_words, r.n_hit, r.n_items, r.contaminated) for r in judge(docs, bench).collect())
    assert got == [(1, 0, 0, 0, False), (2, 0, 0, 0, False), (3, 3, 2, 2, True), (3, 3, 2, 2, True)]
    assert sorted(r.doc_id for r in clean(docs, bench).collect()) == [1, 2]
    assert judge(docs.limit(0), bench).count() == 0
    assert judge(docs, bench.limit(0)).filter("n_hit > 0").count() == 0
    assert cut_out("A one-two, THREE four", [(1, 3)]) == "A , THREE four"


def test_items_repeated_and_without_id(spark):
    docs = spark.createDataFrame([(1, "a one two b"), (2, "three four"), (3, "five")], "doc_id long, text string")
    bench = spark.createDataFrame([("i1", "one two"), ("i1", "three four"), ("i1", "one two"), (None, "five"), ("i2", "one two")], "item_id string, text string")
    sha = lambda *x: hashlib.sha256(",".join(x).encode()).hexdigest()
    for block in (2, 1000):
        got = sorted((r.doc_id, r.n_hit, r.n_items, r.items_sha256) for r in judge(docs, bench, block_words=block).collect())
        assert got == [(1, 2, 2, sha("i1", "i2")), (2, 2, 1, sha("i1")), (3, 1, 0, sha(""))]


def test_many_blocks_in_bounded_memory(spark, monkeypatch):
    """400 blocks: the task reads one automaton at a time, and lots of texts at every size give the same rows."""
    from marlstone.llm import decontaminate as D

    rng = random.Random(4)
    word = lambda: "w" + str(rng.randrange(5000))
    items = [(f"i{k}", " ".join(word() for _ in range(20))) for k in range(400)]
    texts = [" ".join([*(word() for _ in range(30)), *(items[k % 400][1].split()[:14]), *(word() for _ in range(30))]) for k in range(300)] + ["w1 " * 1_000_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id string, text string")
    want = sorted(judge(docs, bench).collect())
    assert sum(r.contaminated for r in want) == 300
    blocks = list(D.blocks_of(bench, "item_id", "text", 13, 20))
    assert len(blocks) == 400 and max(len(b.length) for b in blocks) < 60
    for lot in (1 << 10, 1 << 30):
        monkeypatch.setattr(D, "LOT_CHARS", lot)
        assert sorted(judge(docs.coalesce(1), bench, block_words=200).collect()) == want
    assert sorted(r.doc_id for r in clean(docs, bench, block_words=200).collect()) == [300]


def test_many_short_items(spark):
    """Thousands of items of the same word are one state; a word's step doesn't go through them."""
    docs = spark.createDataFrame([(1, "yes " * 20_000)], "doc_id long, text string")
    bench = spark.createDataFrame([(f"i{k}", "yes") for k in range(3000)], "item_id string, text string")
    r = judge(docs, bench).first()
    assert (r.n_hit, r.n_items, r.contaminated) == (20_000, 3000, True)
