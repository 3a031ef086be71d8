"""Connected components of a graph as DataFrames: least labels with pointer jumping, a stored table for each round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored


def components(edges: DataFrame) -> DataFrame:
    """edges: u, v. Returns node, label: the least node of its component. Nodes without edges aren't listed."""
    both = stored(edges.select("u", "v").union(edges.select("v", "u")).filter("u <> v").distinct(), "edges")
    labels = stored(both.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.least("u", "v").alias("label")), "labels")
    while True:
        near = both.join(labels, F.col("v") == F.col("node")).groupBy("u").agg(F.min("label").alias("near"))
        told = labels.join(near, F.col("node") == F.col("u")).select("node", F.least("label", "near").alias("label"), F.col("label").alias("was"))
        told = stored(told, "labels")
        up = told.select(F.col("node").alias("up"), F.col("label").alias("top"))
        new = stored(told.join(up, F.col("label") == F.col("up")).select("node", F.least("label", "top").alias("label"), "was"), "labels")
        done = new.filter("label <> was").isEmpty()
        labels = new.select("node", "label")
        if done:
            return labels
