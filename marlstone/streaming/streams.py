"""Structured Streaming over a table's files: each runs to the end of what is there and gives its result as a table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import new_place


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a stream; NTZ times become timestamps, as watermarks ask for them.

    All files there are come in one batch: they aren't in order of time, and a watermark between them would drop rows as late.
    """
    place = f"{sf_dir}/{name}.parquet"
    schema = spark.read.parquet(place).schema
    reader = spark.readStream.schema(schema)
    # a table of one file is picked from its folder, one of many is the folder itself
    single = spark.read.format("binaryFile").load(place).select("path").limit(2).collect()
    if len(single) == 1 and single[0].path.rstrip("/").endswith(f"{name}.parquet"):
        df = reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)
    else:
        df = reader.parquet(place)
    return df.select(*[F.col(f.name).cast("timestamp").alias(f.name) if f.dataType.typeName() == "timestamp_ntz" else F.col(f.name) for f in schema.fields])


def run(df: DataFrame, mode: str, name: str, handle: Callable[[DataFrame, int], None] | None = None) -> DataFrame:
    """Run to the end. append: rows go to Parquet as they become final. update and complete: handle(batch, number) takes each batch."""
    spark = df.sparkSession
    place = new_place(spark, name)
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", f"{place}-state").trigger(availableNow=True)
    if mode == "append":
        query = writer.format("parquet").option("path", place).start()
    else:
        query = writer.foreachBatch(handle or (lambda batch, n: batch.write.parquet(f"{place}/batch={n:06d}"))).start()
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return spark.read.schema(df.schema).parquet(place) if mode == "append" else spark.read.option("basePath", place).parquet(f"{place}/*")


def latest(batches: DataFrame, keys: list[str]) -> DataFrame:
    """Of each key the row of the last batch that has it: an upsert sink read back."""
    rest = [c for c in batches.columns if c not in (*keys, "batch")]
    return batches.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col("batch")).alias("r")).select(*keys, "r.*")


def tumbling(events: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def sliding(events: DataFrame, width: str = "2 hours", step: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    return events.withWatermark("ts", late).groupBy(F.window("ts", width, step)).agg(F.count("*").alias("n"))


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """A worker's stretch of activity ends after a gap without a sign of life."""
    return events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n"))


def once_by_id(events: DataFrame, late: str = "10 minutes") -> DataFrame:
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])
