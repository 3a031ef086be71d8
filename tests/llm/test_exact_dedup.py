"""Copies against grouping by text; the Bloom filter's certainty."""

from collections import defaultdict

from pyspark.sql import functions as F

from marlstone.llm import bloom
from marlstone.llm.exact_dedup import decisions, drop_copies


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    groups = defaultdict(list)
    for r in docs.collect():
        groups[r.text].append(r.doc_id)
    want = {i: (max(g), len(g)) for g in groups.values() for i in g}
    got = {r.doc_id: (r.keep_id, r.group_size) for r in decisions(docs).collect()}
    assert got == want
    kept = drop_copies(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(max(g) for g in groups.values())


def test_edges(spark):
    rows = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (3, "x", "c"), (3, "x", "c"), (None, "x", "d"), (None, "y", "e"), (5, "é" * 100_000, "f")], "doc_id long, text string, digest string")
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in decisions(rows).collect()), key=repr)
    assert got == sorted([(1, 2, 2, False), (2, 2, 2, True), (3, 3, 3, True), (3, 3, 3, True), (None, 3, 3, False), (None, None, 1, True), (5, 5, 1, True)], key=repr)
    assert sorted((r.digest for r in drop_copies(rows).collect())) == ["b", "c", "c", "e", "f"]
    assert decisions(rows.limit(0)).count() == 0 and drop_copies(rows.limit(0)).count() == 0


CLASHING = ["_ms_digest", "_ms_slot", "_ms_slot0", "_ms_maybe", "_ms_bits", "_ms_bits0", "_ms_bucket", "_ms_bucket0", "_ms_of", "_ms_keep", "digest", "maybe", "slot", "keep_id", "_MS_OF"]


def test_names_that_clash(spark):
    for name in CLASHING:
        rows = spark.createDataFrame([(1, "x", "a"), (2, "x", "b"), (3, "y", "c")], f"doc_id long, text string, {name} string")
        kept = drop_copies(rows)
        assert kept.columns == rows.columns and sorted(tuple(r) for r in kept.collect()) == [(2, "x", "b"), (3, "y", "c")]
        assert sorted((r.doc_id, r.keep_id) for r in decisions(rows).collect()) == [(1, 2), (2, 2), (3, 3)]


def test_blocks_of_the_filter(spark, monkeypatch):
    """A filter cut into many blocks gives the same rows as one."""
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), (F.col("id") % 3100).cast("string").alias("text"))
    want = sorted(map(tuple, decisions(rows).collect()))
    assert sum(r[3] for r in want) == 3100
    monkeypatch.setattr(bloom, "MAX_SLOTS", 1 << 13)
    monkeypatch.setattr(bloom, "slots_for", lambda keys: 1 << 15)
    assert bloom.Filter(rows.limit(5), "text", 5).blocks == 4
    got = decisions(rows)
    assert got._jdf.queryExecution().toString().count("bits") <= 2 * 2  # one block's bits at a time: what the others said is a stored table
    assert sorted(map(tuple, got.collect())) == want
    assert sorted(r.doc_id for r in drop_copies(rows).collect()) == list(range(900, 4000))
    assert bloom.without(rows, "doc_id", rows.filter("doc_id < 7"), "doc_id", 7).count() == 3993


def test_few_rows_are_moved_for_nothing(spark):
    """Of rows that are all unique next to none reach the second grouping."""
    from marlstone.llm.exact_dedup import _groups, _passes

    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    flagged, groups = _groups(*_passes(rows, "doc_id", "text", lambda c: c))
    assert flagged.filter("maybe").count() < 200 and groups.count() < 200


def test_filter_is_certain_where_it_says_no(spark):
    keys = spark.range(3000).select(F.col("id").alias("k"))
    for slots in (1 << 13, bloom.slots_for(3000)):
        bits = bloom.bits_set(keys, "k", slots)
        tested = bloom.with_test(spark.range(6000), F.col("id"), bits, slots, "maybe")
        assert tested.filter("id < 3000 and not maybe").count() == 0
    assert tested.filter("id >= 3000 and maybe").count() < 200
    assert bloom.only(spark.range(50), "id", keys.filter("k < 10"), "k", 10).count() == 10
    assert bloom.without(spark.range(50), "id", keys.filter("k < 10"), "k", 10).count() == 40
