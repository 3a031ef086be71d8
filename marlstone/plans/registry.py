"""Queries register here by name, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
COVERS: dict[str, tuple[str, ...]] = {}


class Tables:
    """The tables of a folder by attribute, read when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.folder = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(covers: str, sql: str | None = None):
    """Register f(tables) under its own name; covers: the survey's operator ids."""

    def add(f: Callable[[Tables], DataFrame]):
        name = f.__name__
        if name in QUERIES:
            raise ValueError(f"twice: {name}")
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        COVERS[name] = tuple(covers.split())
        if sql:
            ORACLES[name] = sql
        return f

    return add
