"""Joins that Spark has no operator for: as-of, nearest in the plane, unordered pairs within groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import stored


def asof(left: DataFrame, right: DataFrame, key: str, at: str, take: str, every: int = 86_400) -> DataFrame:
    """left with the take of the latest right row of its key at or before its time (null if none), as column asof_<take>.

    Rows are dealt out by key and time slice of `every` seconds, so that one busy key is spread over many tasks; what a slice inherits from those
    before it is found on one row per slice. Both sides have key and at (timestamp); equal times of right: the greatest take.
    """
    slice_of = F.floor(F.unix_micros(F.col(at).cast("timestamp")) / F.lit(every * 1_000_000))
    out = f"asof_{take}"
    both = left.withColumns({"_side": F.lit(1), "_take": F.lit(None).cast(dict(right.dtypes)[take])}).unionByName(
        right.select(key, at, F.lit(0).alias("_side"), F.col(take).alias("_take")), allowMissingColumns=True
    ).withColumn("_slice", slice_of)
    # within a slice
    inside = Window.partitionBy(key, "_slice").orderBy(at, "_side", "_take").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = both.withColumn(out, F.last("_take", ignorenulls=True).over(inside))
    # what each slice inherits
    last = both.filter("_side = 0").groupBy(key, "_slice").agg(F.max_by("_take", F.struct(at, "_take")).alias("_last"))
    slices = both.filter("_side = 1").select(key, "_slice").distinct().join(last, [key, "_slice"], "full")
    before = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    inherited = slices.select(key, "_slice", F.last("_last", ignorenulls=True).over(before).alias("_old"))
    return seen.filter("_side = 1").join(inherited, [key, "_slice"], "left").withColumn(out, F.coalesce(out, "_old")).select(*left.columns, out)


def nearest(left: DataFrame, right: DataFrame, page: str, within: float, left_id: str, right_id: str) -> DataFrame:
    """For each left point the nearest right point of its page within a distance; both have page, x and y.

    The plane is cut into squares as wide as the distance; a left point meets the nine around it only. Distances are told to six places; ties: the least right id.
    """
    cell = lambda c: F.floor(F.col(c) / F.lit(within))
    around = F.explode(F.expr("flatten(transform(sequence(-1, 1), i -> transform(sequence(-1, 1), j -> struct(i as i, j as j))))"))
    l = left.select(F.col(page).alias("page"), F.col(left_id).alias("left_id"), F.col("x").alias("lx"), F.col("y").alias("ly"), cell("x").alias("cx"), cell("y").alias("cy"), around.alias("d"))
    l = l.select("page", "left_id", "lx", "ly", (F.col("cx") + F.col("d.i")).alias("cx"), (F.col("cy") + F.col("d.j")).alias("cy"))
    r = right.select(F.col(page).alias("page"), F.col(right_id).alias("right_id"), F.col("x").alias("rx"), F.col("y").alias("ry"), cell("x").alias("cx"), cell("y").alias("cy"))
    near = l.join(r, ["page", "cx", "cy"]).withColumn("distance", F.round(F.hypot(F.col("lx") - F.col("rx"), F.col("ly") - F.col("ry")), 6)).filter(F.col("distance") <= within)
    return near.groupBy("page", "left_id").agg(F.min(F.struct("distance", "right_id")).alias("m")).select("page", "left_id", "m.right_id", "m.distance")


def pairs_within(rows: DataFrame, group: str, item: str, least: int = 1) -> DataFrame:
    """(a, b, n): unordered pairs of different items that share at least `least` groups; each group's items are made distinct first."""
    once = rows.select(group, item).distinct()
    a, b = once.select(group, F.col(item).alias("a")), once.select(group, F.col(item).alias("b"))
    return a.join(b, group).filter("a < b").groupBy("a", "b").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def box_overlap(prefix_a: str, prefix_b: str) -> Column:
    """Intersection over union of two boxes with columns <prefix>x0, y0, x1, y1."""
    ax0, ay0, ax1, ay1 = (F.col(f"{prefix_a}{c}") for c in ("x0", "y0", "x1", "y1"))
    bx0, by0, bx1, by1 = (F.col(f"{prefix_b}{c}") for c in ("x0", "y0", "x1", "y1"))
    w = F.greatest(F.lit(0.0), F.least(ax1, bx1) - F.greatest(ax0, bx0))
    h = F.greatest(F.lit(0.0), F.least(ay1, by1) - F.greatest(ay0, by0))
    both = w * h
    union = (ax1 - ax0) * (ay1 - ay0) + (bx1 - bx0) * (by1 - by0) - both
    return F.when(union > 0, both / union).otherwise(F.lit(0.0))


def overlapping(boxes: DataFrame, group: str, above: float, cell: float = 16.0, block: int = 512) -> DataFrame:
    """(a, b, iou), a < b: pairs of boxes (id, group, x0, y0, x1, y1) of a group whose intersection over union is greater than above.

    The overlap is worked out once for each pair of different sides that meet in a grid cell, where the least corner of what both share lies; boxes of these sides are then paired without looking at others, so the work is that of the
    result. Boxes of the same sides go in blocks of about so many, and pairs of blocks are dealt out by number, as few bytes make many pairs."""
    sides = ["x0", "y0", "x1", "y1"]
    width = int(boxes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kinds = stored(boxes.groupBy(group, *sides).agg(F.count("*").alias("n")).withColumn("kind", F.monotonically_increasing_id()), "kinds")
    reach = lambda lo, hi: F.explode(F.expr(f"sequence(int(floor({lo} / {cell})), int(floor({hi} / {cell})))"))
    cells = kinds.withColumn("i", reach("x0", "x1")).withColumn("j", reach("y0", "y1")).repartition(width, group, "i", "j")
    side = lambda p: cells.select(group, "i", "j", *[F.col(c).alias(f"{p}_{c}") for c in ("kind", *sides)])
    first = (F.col("i") == F.floor(F.greatest("a_x0", "b_x0") / cell)) & (F.col("j") == F.floor(F.greatest("a_y0", "b_y0") / cell))
    met = side("a").join(side("b"), [group, "i", "j"]).filter("a_kind <= b_kind").filter(first)
    near = stored(met.withColumn("iou", box_overlap("a_", "b_")).filter(F.col("iou") > above).select("a_kind", "b_kind", "iou"), "near")
    told = boxes.join(kinds, [group, *sides]).groupBy("kind", F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / block)).alias("k")).agg(F.collect_list("id").alias("ids"))
    blocks = stored(told.select("kind", "ids"), "blocks")
    pairs = near.join(blocks.toDF("a_kind", "ps"), "a_kind").join(blocks.toDF("b_kind", "qs"), "b_kind").repartition(width)
    rows = pairs.select((F.col("a_kind") == F.col("b_kind")).alias("same"), "iou", "qs", F.explode("ps").alias("p")).select("same", "iou", "p", F.explode("qs").alias("q"))
    return rows.filter("p <> q and (not same or p < q)").select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"), "iou")
