"""Reading and writing tables: coerced schemas, incremental upserts, partitioned exports, stored intermediates."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or one of our own where it is unset (local runs)."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not folder:
        folder = getattr(spark.sparkContext, "_marlstone_tables", None)
        if folder is None:
            if not (spark.sparkContext.master or "").startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            folder = spark.sparkContext._marlstone_tables = "file://" + tempfile.mkdtemp(prefix="marlstone-")
    return folder


def new_place(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/marlstone/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again, so that its lineage ends here."""
    place = new_place(df.sparkSession, name)
    df.write.parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)


def register_views(spark: SparkSession, places: dict[str, str]) -> dict[str, bool]:
    """A temporary view for each name; tells which can be read."""
    alive = {}
    for name, place in places.items():
        try:
            spark.read.parquet(place).createOrReplaceTempView(name)
            alive[name] = True
        except Exception as e:  # noqa: BLE001 - a missing or unreadable table is an answer here
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER" not in str(e):
                raise
            alive[name] = False
    return alive


def coerced(df: DataFrame, schema: T.StructType) -> DataFrame:
    """df in the schema given: casts that can't fail, missing columns null, others left out."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])


def upserted(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """existing without the rows whose key comes again, and the new rows; of equal keys in new, one stays."""
    return existing.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new.dropDuplicates(keys), allowMissingColumns=True)


def export_partitioned(df: DataFrame, place: str, by: str, codec: str = "zstd") -> None:
    df.write.mode("overwrite").option("compression", codec).partitionBy(by).parquet(place)


def changed_files(spark: SparkSession, pattern: str, manifest: DataFrame | None) -> DataFrame:
    """path and modified of the files that the manifest doesn't have in this state."""
    now = spark.read.format("binaryFile").load(pattern).select("path", F.col("modificationTime").alias("modified"))
    return now if manifest is None else now.join(manifest, ["path", "modified"], "left_anti")


def stamped(df: DataFrame, settings: str, created: str) -> DataFrame:
    """df with pipeline_hash (of the settings it was made with) and created_at."""
    return df.withColumn("pipeline_hash", F.substring(F.sha2(F.lit(settings), 256), 1, 16)).withColumn("created_at", F.lit(created).cast("timestamp"))


def read_json_documents(spark: SparkSession, place: str, schema: str, most: int | None = None) -> DataFrame:
    """One JSON document a file, in order of path; files that can't be read as such are left out. most: so many files, the first ones."""
    rows = spark.read.schema(f"{schema}, _corrupt_record string").option("mode", "PERMISSIVE").option("recursiveFileLookup", "true").json(place)
    rows = rows.withColumn("path", F.col("_metadata.file_path")).filter("_corrupt_record is null").drop("_corrupt_record")
    return rows.orderBy("path").limit(most) if most is not None else rows


def with_fallback(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """The rows of first, and those of second whose key first doesn't have."""
    return first.unionByName(second.join(first.select(key), key, "left_anti"), allowMissingColumns=True)


def merged_graph(existing: DataFrame, new: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """Rows of both by their keys, each once: of equal keys the row of greatest order, the new one where that is equal. Doing it again changes nothing."""
    both = existing.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    others = [c for c in existing.columns if c not in keys]
    best = both.groupBy(*keys).agg(F.max_by(F.struct(*others), F.struct(order, F.col("_new"), *others)).alias("_b"))
    return best.select(*keys, "_b.*").select(*existing.columns)


def markdown_table(df: DataFrame) -> DataFrame:
    """df as the lines of a Markdown table (ord, line): header, rule and a line for each row, in order of the columns."""
    cells = [F.coalesce(F.replace(F.col(c).cast("string"), F.lit("|"), F.lit("\\|")), F.lit("")) for c in df.columns]
    line = lambda parts: F.concat(F.lit("| "), F.concat_ws(" | ", *parts), F.lit(" |"))
    head = df.sparkSession.createDataFrame([(0, "| " + " | ".join(df.columns) + " |"), (1, "|" + "---|" * len(df.columns))], "ord int, line string")
    return head.unionByName(df.select(F.lit(2).alias("ord"), line(cells).alias("line")))


def append_log(df: DataFrame, place: str) -> None:
    """A run log: one JSON line and one CSV row for each record, added to what is there."""
    df.write.mode("append").json(f"{place}/jsonl")
    df.write.mode("append").option("header", "true").csv(f"{place}/csv")
