"""Session settings shared by the entry points, the bench and the tests."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("marlstone")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
