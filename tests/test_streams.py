"""Streams over a table of many files, not in order of time, against the table as one file."""

import pytest

from marlstone.plans import catalog  # noqa: F401
from marlstone.plans.registry import QUERIES
from marlstone.streaming import backlog as B


@pytest.mark.parametrize("name", ["st_tumbling", "st_sliding", "st_sessions", "st_once", "st_limited", "st_new_files", "st_quiet_workers"])
def test_many_files(spark, sf_dir, tmp_path, name):
    place = f"{tmp_path}/events.parquet"
    spark.read.parquet(f"{sf_dir}/events.parquet").repartition(20).write.parquet(place)
    assert len(spark.read.parquet(place).inputFiles()) == 20
    got, want = (sorted(map(repr, QUERIES[name](spark, folder).collect())) for folder in (str(tmp_path), sf_dir))
    assert got == want


def test_order_limit_and_restart(spark, tmp_path):
    """Files come in order of time, so many a batch, and a start that was cut off goes on with the batch it was cut off in."""
    rows = spark.range(1000).selectExpr("id", "timestamp_seconds((id * 7919) % 1000) AS ts")
    B.in_order(rows, f"{tmp_path}/inbox", "ts", 5)
    seen = []

    def handle(batch, number):
        seen.append((number, batch.agg({"ts": "min"}).first()[0], batch.count()))

    go = lambda batches: B.go_on(B.limited(spark, f"{tmp_path}/inbox", rows.schema, 2), "append", str(tmp_path), handle, batches)
    assert go(1) == 1 and go(None) == 2 and go(None) == 0
    assert [n for n, _, _ in seen] == [0, 1, 2] and [t for _, t, _ in seen] == sorted(t for _, t, _ in seen) and sum(c for _, _, c in seen) == 1000


def test_a_quiet_worker_is_reset_by_its_timer(spark, tmp_path):
    """Worker 1 never comes again; the other's signs move the watermark, and the timer tells."""
    beats = [(1, 1000), (1, 1060), (2, 1030), (2, 1090), (2, 5000), (2, 10000)]
    rows = spark.createDataFrame(beats, "worker long, s long").selectExpr("worker", "timestamp_seconds(s) AS ts")
    B.in_order(rows, f"{tmp_path}/inbox", "ts", 3)
    got = []
    with B.rocks_state(spark):
        B.go_on(B.quiet(B.limited(spark, f"{tmp_path}/inbox", rows.schema, 1), "worker", "ts", 600_000, "1 second"), "append", str(tmp_path), lambda b, k: got.extend(b.selectExpr("worker", "unix_seconds(last)", "n").collect()))
    assert sorted(map(tuple, got)) == [(1, 1060, 2), (2, 1090, 2), (2, 5000, 1)]
