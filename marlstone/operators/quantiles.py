"""Exact quantiles by group without bringing a group's values together."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SLICES = 4096


def exact_quantiles(rows: DataFrame, group: str, value: str, shares: dict[str, float]) -> DataFrame:
    """group and a column for each share: the quantile with linear interpolation, nulls left out.

    A group's range is cut into SLICES of equal width and counted; only the slices that hold the ranks asked for are looked into, where equal values are
    counted before anything is sorted. A built-in percentile keeps all different values of a group in one task instead.
    """
    known = rows.select(F.col(group).alias("g"), F.col(value).cast("double").alias("v")).filter("v is not null")
    spans = known.groupBy("g").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("n"))
    width = F.col("hi") - F.col("lo")
    at = F.when(width > 0, F.least(F.floor((F.col("v") - F.col("lo")) / width * SLICES), F.lit(SLICES - 1))).otherwise(F.lit(0))
    placed = known.join(spans, "g").select("g", "v", at.cast("int").alias("s"))
    upto = F.sum("c").over(Window.partitionBy("g").orderBy("s"))
    slices = placed.groupBy("g", "s").agg(F.count("*").alias("c")).select("g", "s", (upto - F.col("c")).alias("before"), upto.alias("upto"))
    asked = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(p).alias("p")) for name, p in shares.items()])
    ranks = spans.select("g", (F.col("n") - 1).alias("last"), F.explode(asked).alias("a")).select("g", "a.name", (F.col("a.p") * F.col("last")).alias("h"))
    ranks = ranks.select("g", "name", F.explode(F.array(F.struct(F.floor("h").alias("r"), (1 - (F.col("h") - F.floor("h"))).alias("w")), F.struct((F.floor("h") + 1).alias("r"), (F.col("h") - F.floor("h")).alias("w")))).alias("x"))
    ranks = ranks.select("g", "name", "x.r", "x.w").filter("w > 0")
    wanted = ranks.join(slices, "g").filter("r >= before and r < upto").select("g", "s", "before", "name", "r", "w")
    counted = placed.join(wanted.select("g", "s").distinct(), ["g", "s"], "left_semi").groupBy("g", "s", "v").agg(F.count("*").alias("c"))
    inside = F.sum("c").over(Window.partitionBy("g", "s").orderBy("v"))
    counted = counted.select("g", "s", "v", (inside - F.col("c")).alias("from"), inside.alias("to"))
    met = wanted.join(counted, ["g", "s"]).filter((F.col("r") - F.col("before") >= F.col("from")) & (F.col("r") - F.col("before") < F.col("to")))
    return met.groupBy(F.col("g").alias(group)).agg(*[F.sum(F.when(F.col("name") == name, F.col("w") * F.col("v"))).alias(name) for name in shares])
