"""Sampling operators that don't gather a stratum in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def stratified(rows: DataFrame, stratum: str, key: str, share: float, least: int) -> DataFrame:
    """Of each stratum the max(least, round(share * n)) rows (all, if fewer) of least md5 of the key, ties by key.

    Rows are counted by stratum and the first three digits of the digest; only the one slice in which a stratum's quota ends is ranked, so that a stratum of any
    size is spread over thousands of slices.
    """
    hashed = rows.withColumn("_h", F.md5(F.col(key).cast("string"))).withColumn("_slice", F.substring("_h", 1, 3))
    slices = hashed.groupBy(stratum, "_slice").agg(F.count("*").alias("_n"))
    w = Window.partitionBy(stratum).orderBy("_slice")
    quota = F.least(F.sum("_n").over(Window.partitionBy(stratum)).cast("double"), F.greatest(F.lit(float(least)), F.round(F.sum("_n").over(Window.partitionBy(stratum)) * share))).cast("long")
    slices = slices.select(stratum, "_slice", (F.sum("_n").over(w) - F.col("_n")).alias("_before"), F.sum("_n").over(w).alias("_upto"), quota.alias("_k")).filter("_before < _k")
    met = hashed.join(slices, [stratum, "_slice"])
    whole = met.filter("_upto <= _k")
    rank = F.row_number().over(Window.partitionBy(stratum, "_slice").orderBy("_h", key))
    edge = met.filter("_upto > _k").withColumn("_r", rank).filter("_before + _r <= _k").drop("_r")
    return whole.unionByName(edge).select(*rows.columns)
