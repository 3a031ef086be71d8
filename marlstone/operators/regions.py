"""Regions of pages: blocks of one family merged while they are near, captions and contexts attached to the nearest region, classes, padding and crops.

Defined cases: blocks without a family that lie near no region are left out; boxes with a null side are left out; families never merge; a page without blocks has no region; ties of
distance go to figures before tables, then to the region with the least first block. What merges in a round is merged at once, so the order of blocks doesn't matter.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import stored
from .entities import region_class
from .graphs import components

# Families, distances in points, words of captions, room around a region by its class (top, bottom, left, right), the share of a page from which all of it is taken.
FAMILIES = {"figure": "figure", "graphic": "figure", "table": "table", "table_head": "table", "formula": "formula"}
ACROSS, DOWN, MIDDLES, TIGHT = 80.0, 120.0, 40.0, 40.0
CAPTION_WORDS = ("figure", "fig.", "fig ", "table", "tab.", "tab ", "chart", "scheme", "diagram", "equation", "eq.", "eq ", "appendix", "supplementary")
ROOM = {
    "FIGURE_REGION": (15, 25, 10, 10), "TABLE_REGION": (20, 30, 10, 10), "FORMULA_REGION": (35, 35, 20, 20), "CHART_REGION": (15, 25, 10, 10), "MULTI_PANEL_FIGURE": (10, 20, 8, 8),
    "SCIENTIFIC_DIAGRAM": (15, 25, 10, 10),
}
WHOLE_PAGE = 0.55
PAGE = (595.276, 841.890)

SIDES = ("x0", "y0", "x1", "y1")
CELL = 256.0


def _gap(axis: str, a: str = "a_", b: str = "b_") -> Column:
    return F.greatest(F.lit(0.0), F.greatest(F.col(f"{a}{axis}0"), F.col(f"{b}{axis}0")) - F.least(F.col(f"{a}{axis}1"), F.col(f"{b}{axis}1")))


def _shares(axis: str, a: str = "a_", b: str = "b_") -> Column:
    return (F.col(f"{a}{axis}0") < F.col(f"{b}{axis}1")) & (F.col(f"{b}{axis}0") < F.col(f"{a}{axis}1"))


def near() -> Column:
    """Whether boxes a_ and b_ are one thing: they overlap, stand under one another, or side by side at one height."""
    middles = F.abs((F.col("a_y0") + F.col("a_y1")) / 2 - (F.col("b_y0") + F.col("b_y1")) / 2)
    return (_shares("x") & _shares("y")) | (_shares("x") & (_gap("y") <= DOWN)) | ((middles < MIDDLES) & (_gap("x") <= ACROSS))


def tight() -> Column:
    """The rule for formulas that have their contexts already: they overlap, or stand closely under one another."""
    return _shares("x") & (_shares("y") | (_gap("y") <= TIGHT))


def _in_cells(rows: DataFrame, across: float, down: float) -> DataFrame:
    reach = lambda lo, hi, by: f"sequence(int(floor(({lo} - {by}) / {CELL})), int(floor(({hi} + {by}) / {CELL})))"
    return rows.withColumn("_cell", F.expr(f"explode(flatten(transform({reach('x0', 'x1', across)}, i -> transform({reach('y0', 'y1', down)}, j -> struct(i as i, j as j)))))"))


def grown(regions: DataFrame, rule: Callable[[], Column]) -> tuple[DataFrame, DataFrame]:
    """(regions, parts): regions (doc, page, family, id and sides) merged while any two of one page and family fit the rule, by the boxes around what is merged; and node, label of each old id.

    A round joins boxes that share a grid cell; only pages on which something was merged go into the next.
    """
    group = ["doc", "page", "family"]
    live, done, parts = regions.select(*group, "id", *SIDES), None, regions.select(F.col("id").alias("node"), F.col("id").alias("label"))
    while True:
        a = _in_cells(live, ACROSS, DOWN).select(*group, "_cell", F.col("id").alias("a"), *[F.col(c).alias(f"a_{c}") for c in SIDES])
        b = _in_cells(live, 0.0, 0.0).select(*group, "_cell", F.col("id").alias("b"), *[F.col(c).alias(f"b_{c}") for c in SIDES])
        met = a.join(b, [*group, "_cell"]).filter((F.col("a") != F.col("b")) & rule())
        pairs = stored(met.select("a", "b").union(met.select("b", "a")).distinct(), "near_boxes")
        if pairs.isEmpty():
            return (live if done is None else done.unionByName(live)), parts
        labels = components(pairs, pairs.select(F.col("a").alias("node")).distinct())
        boxes = [*(F.min(c).alias(c) for c in SIDES[:2]), *(F.max(c).alias(c) for c in SIDES[2:]), F.count("*").alias("_n")]
        new = stored(live.join(labels, F.col("id") == F.col("node"), "left").groupBy(*group, F.coalesce("label", "id").alias("id")).agg(*boxes), "regions")
        moved = labels.select(F.col("node").alias("label"), F.col("label").alias("_to"))
        parts = stored(parts.join(moved, "label", "left").select("node", F.coalesce("_to", "label").alias("label")), "region_parts")
        busy = new.filter("_n > 1").select(*group).distinct()
        still = new.join(busy, group, "left_anti").drop("_n")
        done = still if done is None else done.unionByName(still)
        live = new.join(busy, group, "left_semi").drop("_n")


def attached(regions: DataFrame, blocks: DataFrame) -> DataFrame:
    """block, id: the region of its page that a caption or context belongs to, by vertical gap and half the horizontal one; a text with a caption's word may be further off."""
    slices = lambda lo, hi, by: F.explode(F.sequence(F.floor((F.col(lo) - by) / 180), F.floor((F.col(hi) + by) / 180))).alias("_slice")
    r = regions.select("doc", "page", "family", "id", *[F.col(c).alias(f"a_{c}") for c in SIDES], slices("y0", "y1", DOWN * 1.5))
    b = blocks.select("doc", "page", F.col("id").alias("block"), "text", *[F.col(c).alias(f"b_{c}") for c in SIDES], slices("y0", "y1", 0.0))
    told = F.lower(F.coalesce("text", F.lit("")))
    worded = F.lit(False)
    for w in CAPTION_WORDS:
        worded = worded | told.contains(w)
    v, h = _gap("y"), _gap("x")
    score = F.when(_shares("x") & _shares("y"), 0.0).when((_shares("x") | (h <= ACROSS)) & (v <= DOWN), v + h * 0.5).when(worded & (v <= DOWN * 1.5), v + h)
    met = r.join(b, ["doc", "page", "_slice"]).withColumn("_score", score).filter("_score is not null")
    return met.groupBy("block").agg(F.min(F.struct("_score", "family", "id")).alias("_m")).select("block", "_m.id")


def regions(blocks: DataFrame, width: float = PAGE[0], height: float = PAGE[1]) -> DataFrame:
    """region_id, doc, page, region_type, x0, y0, x1, y1 (with room around, within the page), crop, blocks (ids), caption, formula.

    blocks: doc, page, id (one for each block of the table), role (figure, graphic, table, table_head, formula, caption, label, context), text and sides.
    """
    whole = F.lit(True)
    for c in SIDES:
        whole = whole & F.col(c).isNotNull()
    family = F.coalesce(*[F.when(F.col("role") == r, f) for r, f in FAMILIES.items()])
    blocks = blocks.filter(whole).withColumn("family", family)
    first, parts = grown(blocks.filter("family is not null"), near)
    first = stored(first, "first_regions")
    pictures, formulas = first.filter("family <> 'formula'"), first.filter("family = 'formula'")
    notes = attached(pictures, blocks.filter("role in ('caption', 'label')")).unionByName(attached(formulas, blocks.filter("role = 'context'")))
    notes = stored(notes, "attached")
    # the boxes around what was attached, which may touch each other now
    sides = blocks.join(notes.withColumnRenamed("id", "_region"), F.col("id") == F.col("block")).select(F.col("_region").alias("id"), *SIDES)
    around = first.select("id", *SIDES).unionByName(sides).groupBy("id").agg(*(F.min(c).alias(c) for c in SIDES[:2]), *(F.max(c).alias(c) for c in SIDES[2:]))
    wide = stored(first.select("doc", "page", "family", "id").join(around, "id"), "wide_regions")
    second, moved = grown(wide.filter("family <> 'formula'"), near)
    third, shifted = grown(wide.filter("family = 'formula'"), tight)
    last = second.unionByName(third)
    moves = moved.unionByName(shifted).select(F.col("node").alias("id"), F.col("label").alias("_to"))
    belongs = parts.select(F.col("node").alias("block"), F.col("label").alias("id")).unionByName(notes).join(moves, "id").select("block", F.col("_to").alias("id"))
    held = blocks.select(F.col("id").alias("block"), "role", "text", F.col("y0").alias("_y"), F.col("x0").alias("_x")).join(belongs, "block")
    say = lambda *roles: F.array_join(F.transform(F.array_sort(F.filter(F.collect_list(F.struct("_y", "_x", "block", "role", "text")), lambda s: s["role"].isin(*roles) & (s["text"] != ""))), lambda s: s["text"]), " ")
    kept = held.groupBy("id").agg(F.array_sort(F.collect_list("block")).alias("blocks"), F.collect_list("role").alias("roles"), say("caption", "label").alias("caption"), say("formula").alias("formula"))
    # a table's head counts as a table
    roles = F.transform("roles", lambda r: F.when(r == "table_head", "table").otherwise(r))
    rows = last.join(kept, "id").withColumn("roles", roles)
    rows = rows.withColumn("region_type", region_class("roles", "caption", F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")))
    room = lambda k: F.coalesce(*[F.when(F.col("region_type") == t, float(r[k])) for t, r in ROOM.items()])
    padded = rows.withColumns({
        "x0": F.greatest(F.lit(0.0), F.col("x0") - room(2)), "y0": F.greatest(F.lit(0.0), F.col("y0") - room(0)), "x1": F.least(F.lit(width), F.col("x1") + room(3)), "y1": F.least(F.lit(height), F.col("y1") + room(1)),
    })
    share = (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0")) / (width * height)
    n = F.row_number().over(Window.partitionBy("doc").orderBy("page", "family", F.col("blocks")[0]))
    named = F.format_string("%s_p%d_%s_%03d", F.col("doc").cast("string"), F.col("page"), F.substring(F.lower("region_type"), 1, 3), n)
    return padded.select(named.alias("region_id"), "doc", "page", "region_type", *SIDES, F.when(share >= WHOLE_PAGE, "full_page").otherwise("expanded_context").alias("crop"), "blocks", "caption", "formula")
