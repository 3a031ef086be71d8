"""A registry of work as a fold over events: status, retries, stale workers, queue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The order in which statuses are taken up again.
PRIORITY = ("RETRY", "FAILED", "PENDING", "PROCESSING", "DONE")


def folded(events: DataFrame, key: str, at: Column, status: str) -> DataFrame:
    """The status of each key after its last event, with the number of events (the version) and the time."""
    return events.groupBy(key).agg(F.max_by(status, at).alias("status"), F.count("*").alias("version"), F.max("ts").alias("updated"))


def backoff_seconds(failures: Column, base: int = 60, factor: int = 5) -> Column:
    return (F.lit(base) * F.pow(F.lit(factor), failures)).cast("long")


def priority(status: Column) -> Column:
    out = F.lit(len(PRIORITY))
    for k, s in reversed(list(enumerate(PRIORITY))):
        out = F.when(status == s, k).otherwise(out)
    return out


def registered(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """existing and the new rows whose key isn't there yet."""
    return existing.unionByName(new.join(existing.select(key), key, "left_anti"))


def compare_and_set(rows: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Updates take effect where they name the version at hand; the version goes up by one. applied tells which did."""
    u = updates.select(key, F.col("expected").alias("_expected"), F.col("to_status").alias("_to"))
    hit = F.coalesce(F.col("_expected") == F.col("version"), F.lit(False))
    joined = rows.join(u, key, "left")
    return joined.select(key, F.when(hit, F.col("_to")).otherwise(F.col("status")).alias("status"), (F.col("version") + hit.cast("int")).alias("version"), hit.alias("applied"))


def register_counts(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """One row: how many keys a bulk registration inserts, skips as known and repeats within itself."""
    given = new.groupBy(key).agg(F.count("*").alias("_n"))
    known = given.join(existing.select(key).distinct().withColumn("_known", F.lit(True)), key, "left")
    return known.agg(
        F.count_if(F.col("_known").isNull()).alias("inserted"), F.count_if(F.col("_known").isNotNull()).alias("skipped"), F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("repeated"),
    )


def migrated(rows: DataFrame, migrations: list[tuple[int, dict[str, Column]]]) -> DataFrame:
    """Rows of mixed schema_version brought to the last one: each step (version, columns it sets) applies to the rows of lower versions, in order."""
    for version, columns in sorted(migrations, key=lambda m: m[0]):
        older = F.col("schema_version") < version
        for name, value in columns.items():
            rows = rows.withColumn(name, F.when(older, value).otherwise(F.col(name)) if name in rows.columns else F.when(older, value))
        rows = rows.withColumn("schema_version", F.when(older, version).otherwise(F.col("schema_version")))
    return rows


def stage_states(manifest: DataFrame, current: DataFrame, key: str, stages: list[str]) -> DataFrame:
    """manifest: key, stage, status, hash; current: key, hash (of what the stages would run with now). For each key and stage its state: as recorded, pending if not recorded, stale if recorded under another hash."""
    wanted = current.select(key, F.col("hash").alias("_now"), F.explode(F.array(*[F.lit(s) for s in stages])).alias("stage"))
    met = wanted.join(manifest.select(key, "stage", "status", "hash"), [key, "stage"], "left")
    state = F.when(F.col("status").isNull(), "pending").when(F.col("hash") != F.col("_now"), "stale").otherwise(F.col("status"))
    return met.select(key, "stage", state.alias("state"), (state == "done").alias("done"))
