"""A property graph as two tables, derived in phases from relations, and patterns over it as joins.

Nodes: label, id, name. Edges: kind, src, dst, weight; each (kind, src, dst) once. A phase says which relation gives which edges; running it again adds nothing, as both tables are keyed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Phase:
    """Edges of one kind between nodes of two labels, from a relation; ids are columns of it."""

    kind: str
    relation: DataFrame
    src: tuple[str, Column]  # label and id
    dst: tuple[str, Column]
    weight: Column | None = None


def derived(phases: list[Phase]) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of all phases; of repeated edges the greatest weight stays."""
    nodes = edges = None
    for p in phases:
        weight = F.lit(1.0) if p.weight is None else p.weight.cast("double")
        rows = p.relation.select(F.lit(p.kind).alias("kind"), p.src[1].cast("string").alias("src"), p.dst[1].cast("string").alias("dst"), weight.alias("weight")).filter("src is not null and dst is not null")
        ends = rows.select(F.lit(p.src[0]).alias("label"), F.col("src").alias("id")).union(rows.select(F.lit(p.dst[0]).alias("label"), F.col("dst").alias("id")))
        nodes = ends if nodes is None else nodes.union(ends)
        edges = rows if edges is None else edges.union(rows)
    return nodes.distinct(), edges.groupBy("kind", "src", "dst").agg(F.max("weight").alias("weight"))


def step(edges: DataFrame, kind: str, src: str, dst: str) -> DataFrame:
    """The edges of a kind with their ends named, to be joined to others on equal names."""
    return edges.filter(F.col("kind") == kind).select(F.col("src").alias(src), F.col("dst").alias(dst))


def collected(edges: DataFrame, kind: str, src: str, name: str) -> DataFrame:
    """src and the sorted set of ends of its edges of a kind, as one text; for optional matches. A node's set is as long as its degree."""
    return edges.filter(F.col("kind") == kind).groupBy(F.col("src").alias(src)).agg(F.array_join(F.array_sort(F.collect_set("dst")), ",").alias(name))
