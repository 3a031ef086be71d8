"""What the operators of this package share: stored tables and Arrow maps."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import stored  # noqa: F401 - written to the folder that all executors share

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch holds, so that a Python worker's memory doesn't follow the length of texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1024")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def arrow_map(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | None]], schema) -> DataFrame:
    """mapInArrow with state for each task: make() runs once in a task, what it returns runs on each batch."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = make()
        for batch in batches:
            if batch.num_rows and (out := one(batch)) is not None:
                yield out

    return df.mapInArrow(run, schema)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores in front as it takes to differ from all columns of df."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def bounded_sample(df: DataFrame, most: int) -> DataFrame:
    """At most `most` different rows of df, those of least hash, for fitting a classifier.

    Only rows below a bound on the hash, about four times as many as asked for, are moved; copies of a row are made one before.
    """
    total = df.count()
    share = min(1.0, 4 * most / total) if total else 1.0
    bound = int(-(2**63) + share * (2**64 - 1))
    (of,) = fresh(df, "_ms_hash")
    hashed = df.withColumn(of, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])).filter(F.col(of) <= min(bound, 2**63 - 1))
    return hashed.dropDuplicates([of]).orderBy(of).limit(most).drop(of)


def sample_by_label(df: DataFrame, label: str, most: int, most_labels: int) -> tuple[DataFrame, list[str]]:
    """(different rows of df, about an even share of `most` for each label, those of least hash; the labels, from a count of all rows, the most_labels commonest).

    Shares follow the number of different rows of a label, so the sample is bounded but for chance, and only its rows are moved."""
    (of,) = fresh(df, "_ms_hash")
    hashed = df.withColumn(of, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    found = hashed.groupBy(label).agg(F.count("*").alias("n"), F.approx_count_distinct(of, 0.02).alias("kinds")).orderBy(F.desc("n"), label).limit(most_labels).collect()
    quota = max(1, most // max(1, len(found)))
    within = F.lit(False)
    for r in found:
        bound = int(-(2**63) + min(1.0, quota / (0.95 * max(1, r.kinds))) * (2**64 - 1))
        within = within | ((F.col(label) == r[label]) & (F.col(of) <= min(bound, 2**63 - 1)))
    return hashed.filter(within).dropDuplicates([of]).drop(of), sorted(r[label] for r in found)


def least_of_most(counts: DataFrame, n: str, most: int, which: Column | None = None) -> int:
    """The least count such that at most so many rows (of those for which `which` holds) have it or more. Counts are taken together by
    sixteenths of a power of two, so some thousand rows at most reach the driver."""
    step = F.floor(F.log2(F.col(n).cast("double")) * 16)
    kinds = F.count("*") if which is None else F.sum(which.cast("long"))
    least, taken = 1 << 62, 0
    for r in sorted(counts.groupBy(step.alias("step")).agg(F.min(n).alias("least"), kinds.alias("kinds")).collect(), key=lambda r: -r.step):
        if taken + r.kinds > most:
            break
        least, taken = r.least, taken + r.kinds
    return least
