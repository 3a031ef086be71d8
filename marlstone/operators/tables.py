"""Numeric facts from tables of cells, as joins and aggregates over cells.

A table is rows of (table_id, row_no from 0, cells). Tables whose columns are labelled: the rows at the top (at most HEADER_ROWS) of which half the cells or fewer are numbers are headers; a column's
headers are joined from top to bottom, and the first rule that they match names the metric of the numbers below. Tables that give nothing this way are read by rows: the first
cell of a row that matches a rule names the metric of the numbers to its right. Values outside a metric's bounds are left out.

All steps deal out by table_id and columns; a table's headers are aggregated before they meet its cells. Defined cases: null and empty cells are no numbers and no headers; a table without
rows below its headers, or of headers only, is read by rows; repeated rows of one number give repeated facts; an empty input gives no facts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import parsed
from ..sources.tables import stored

HEADER_ROWS = 4

# What names a metric in a header (first match wins), the metric and its unit.
HEADER_RULES = (
    (r"\bnse\b|\bnash\b|nash[\s\-]?sutcliffe|nash[\s\-]?eff(?:iciency)?", "metric.nse", None),
    (r"\bkge\b|kling[\s\-]?gupta", "metric.kge", None),
    (r"\bpbias\b|percent[\s\-]?bias|p[\s\.]?bias\b", "metric.pbias", "%"),
    (r"\brsr\b", "metric.rsr", None),
    (r"\bioa\b|index[\s\-]?of[\s\-]?agreement", "metric.ioa", None),
    (r"\brmse\b|root[\s\-]?mean[\s\-]?sq(?:uare[d]?)?[\s\-]?err", "metric.rmse", None),
    (r"\bmbe\b|mean[\s\-]?bias[\s\-]?err(?:or)?", "metric.mbe", None),
    (r"\bmae\b|mean[\s\-]?abs(?:olute)?[\s\-]?err", "metric.mae", None),
    (r"\bmse\b", "metric.mse", None),
    (r"\bmape\b|mean[\s\-]?abs(?:olute)?[\s\-]?perc", "metric.mape", "%"),
    (r"\bnmad\b|norm(?:alized)?[\s\-]?median[\s\-]?abs(?:olute)?[\s\-]?dev", "metric.nmad", None),
    (r"\br[\^²2]\b|\br\s*squared\b|\bcoeff(?:icient)?[\s\-]?(?:of[\s\-]?)?determ", "metric.r2", None),
    (r"\bpearson[\s\-]?r\b|correlation[\s\-]?coeff(?:icient)?\b|\bcc\b", "metric.r", None),
    (r"balanced[\s\-]?acc(?:uracy)?", "metric.balanced_acc", None),
    (r"overall[\s\-]?acc(?:uracy)?|\baccuracy\b", "metric.overall_accuracy", None),
    (r"\boa\b", "metric.overall_accuracy", None),
    (r"\bauc[\s\-]?roc\b|\broc[\s\-]?auc\b|\bauc\b|area[\s\-]?under[\s\-]?(?:the[\s\-]?)?(?:roc[\s\-]?)?curve", "metric.auc", None),
    (r"\bf1[\s\-]?(?:score)?\b|\bf[\s\-]?measure\b|dice[\s\-]?(?:score|coeff(?:icient)?)", "metric.f1_score", None),
    (r"\biou\b|intersection[\s\-]?over[\s\-]?union|jaccard", "metric.iou", None),
    (r"\bkappa\b|cohen[\s\-]?kappa", "metric.kappa", None),
    (r"\bmcc\b|matthews[\s\-]?corr(?:elation)?", "metric.mcc", None),
    (r"\bprecision\b|\bppv\b|positive[\s\-]?predictive[\s\-]?value", "metric.precision", None),
    (r"\bpod\b|prob(?:ability)?[\s\-]?of[\s\-]?det(?:ection)?|hit[\s\-]?rate\b|\brecall\b|\bsensitivity\b|\btpr\b", "metric.pod", None),
    (r"\bcsi\b|critical[\s\-]?success[\s\-]?index|threat[\s\-]?score", "metric.csi", None),
    (r"\bfar\b|false[\s\-]?alarm[\s\-]?rat(?:e|io)?", "metric.far", None),
    (r"\bspecificity\b|\btnr\b|true[\s\-]?neg(?:ative)?[\s\-]?rat(?:e|io)?", "metric.specificity", None),
    (r"(?<![a-z])\bcn\b(?![a-z])|curve[\s\-]?num(?:ber)?", "method.scs_cn", None),
)

# The least and greatest plausible value of a metric.
BOUNDS = {
    "metric.nse": (-10.0, 1.0), "metric.kge": (-10.0, 1.0), "metric.pbias": (-200.0, 200.0), "metric.rsr": (0.0, 1e4), "metric.ioa": (0.0, 1.0), "metric.rmse": (0.0, 1e9), "metric.mae": (0.0, 1e9),
    "metric.mse": (0.0, 1e9), "metric.mape": (0.0, 1e4), "metric.mbe": (-1e9, 1e9), "metric.nmad": (0.0, 1e9), "metric.r2": (-10.0, 1.0), "metric.r": (-1.0, 1.0), "metric.overall_accuracy": (0.0, 1.0),
    "metric.balanced_acc": (0.0, 1.0), "metric.auc": (0.0, 1.0), "metric.f1_score": (0.0, 1.0), "metric.iou": (0.0, 1.0), "metric.kappa": (-1.0, 1.0), "metric.mcc": (-1.0, 1.0), "metric.precision": (0.0, 1.0),
    "metric.pod": (0.0, 1.0), "metric.csi": (0.0, 1.0), "metric.far": (0.0, 1.0), "metric.specificity": (0.0, 1.0), "method.scs_cn": (1.0, 100.0),
}
COLUMN_CONFIDENCE, ROW_CONFIDENCE = 0.85, 0.80
UNIT = r"\(([^)]{1,25})\)\s*$"


def metric_of(header: Column, rules: Sequence[tuple[str, str, str | None]] = HEADER_RULES) -> Column:
    """struct(metric, unit) by the first rule found, null if none is; the unit is the rule's."""
    out = F.when(F.lit(False), F.struct(F.lit("").alias("metric"), F.lit("").alias("unit")))
    for pattern, metric, unit in rules:
        out = out.when(header.rlike(f"(?i){pattern}"), F.struct(F.lit(metric).alias("metric"), F.lit(unit).cast("string").alias("unit")))
    return out


def _filled(cell: Column) -> Column:
    return F.coalesce(F.trim(cell), F.lit("")) != ""


def _unit(text: Column, of_rule: Column) -> Column:
    own = F.trim(F.regexp_extract(text, UNIT, 1))
    return F.coalesce(F.nullif(own, F.lit("")), of_rule)


def plausible(facts: DataFrame, bounds: dict[str, tuple[float, float]] = BOUNDS) -> DataFrame:
    """Facts (metric, value) within the bounds of their metric; a table of a few dozen rows is broadcast."""
    limits = facts.sparkSession.createDataFrame([(m, *b) for m, b in bounds.items()], "metric string, low double, high double")
    return facts.join(F.broadcast(limits), "metric", "left").filter("value is not null and (low is null or value between low and high)").drop("low", "high")


def header_depths(rows: DataFrame) -> DataFrame:
    """table_id, depth (rows of headers) of tables that have headers and rows below them."""
    filled = F.filter("cells", lambda c: c.isNotNull())
    numbers = F.size(F.filter(filled, lambda c: parsed(c).isNotNull()))
    heads = (F.size(filled) == 0) | (numbers * 2 <= F.size(filled))
    body = F.when((F.col("row_no") < HEADER_ROWS) & ~heads, F.col("row_no"))
    per = rows.groupBy("table_id").agg(F.min(body).alias("first_body"), F.count("*").alias("n"))
    depth = F.coalesce("first_body", F.least(F.lit(HEADER_ROWS), F.col("n")))
    return per.select("table_id", depth.cast("int").alias("depth"), "n").filter("depth > 0 and depth < n").drop("n")


def by_columns(rows: DataFrame) -> DataFrame:
    """Facts of tables whose columns are labelled: table_id, row_no, place, metric, unit, value, raw, header, row_labels, confidence."""
    depths = header_depths(rows)
    marked = rows.join(depths, "table_id")
    head = marked.filter("row_no < depth").select("table_id", "row_no", F.posexplode("cells").alias("place", "cell")).filter(_filled(F.col("cell")))
    merged = head.groupBy("table_id", "place").agg(F.sort_array(F.collect_list(F.struct("row_no", F.trim("cell").alias("cell")))).alias("c"))  # at most HEADER_ROWS cells
    merged = merged.select("table_id", "place", F.array_join(F.col("c.cell"), " ").alias("header"))
    merged = merged.withColumn("m", metric_of(F.trim(F.regexp_replace("header", UNIT, "")))).filter("m is not null")
    labels = lambda cells, place: F.filter(F.slice(cells, F.lit(1), place), lambda c: _filled(c) & parsed(c).isNull())
    body = marked.filter("row_no >= depth").select("table_id", "row_no", "cells", F.posexplode("cells").alias("place", "cell"))
    body = body.select("table_id", "row_no", "place", F.trim("cell").alias("raw"), parsed(F.col("cell")).alias("value"), F.transform(labels(F.col("cells"), F.col("place")), lambda c: F.trim(c)).alias("row_labels")).filter("value is not null")
    facts = body.join(merged, ["table_id", "place"])
    return plausible(facts.select("table_id", "row_no", "place", F.col("m.metric").alias("metric"), _unit(F.col("header"), F.col("m.unit")).alias("unit"), "value", "raw", "header", "row_labels", F.lit(COLUMN_CONFIDENCE).alias("confidence")))


def by_rows(rows: DataFrame) -> DataFrame:
    """Facts of rows that hold a metric's name and numbers to its right; the same columns as by_columns."""
    named = F.transform("cells", lambda c, i: F.struct(i.alias("place"), F.trim(c).alias("label"), F.when(c.rlike("[A-Za-z]"), metric_of(c)).alias("m")))  # all rules ask for letters
    first = rows.select("table_id", "row_no", "cells", F.explode(F.slice(F.filter(named, lambda x: x["m"].isNotNull()), 1, 1)).alias("x"))  # the rules are tried once for each cell
    cells = first.select("table_id", "row_no", "x", F.posexplode("cells").alias("place", "cell")).filter("place > x.place")
    facts = cells.select(
        "table_id", "row_no", "place", F.col("x.m.metric").alias("metric"), _unit(F.col("x.label"), F.col("x.m.unit")).alias("unit"), parsed(F.col("cell")).alias("value"), F.trim("cell").alias("raw"),
        F.col("x.label").alias("header"), F.array().cast("array<string>").alias("row_labels"), F.lit(ROW_CONFIDENCE).alias("confidence"),
    )
    return plausible(facts)


def numeric_facts(rows: DataFrame) -> DataFrame:
    """rows: table_id, row_no, cells. One fact for each plausible number, with its place, header, labels, confidence and a fact_id by table, metric, value and order."""
    rows = stored(rows, "cells")  # read several times below
    columns = stored(by_columns(rows), "column-facts")
    others = rows.join(columns.select("table_id").distinct(), "table_id", "left_anti")
    facts = columns.unionByName(by_rows(others))
    seq = F.row_number().over(Window.partitionBy("table_id").orderBy("row_no", "place")) - 1  # the numbers of one table
    told = F.concat_ws("|", F.col("table_id").cast("string"), "metric", F.format_string("%.8f", "value"), seq.cast("string"))
    return facts.withColumn("fact_id", F.substring(F.sha1(told), 1, 16))


def best_values(facts: DataFrame) -> DataFrame:
    """For each table and metric the value of greatest confidence, of equals the first in order of rows and columns."""
    order = F.struct(F.col("confidence"), -F.col("row_no"), -F.col("place"))
    return facts.groupBy("table_id", "metric").agg(F.max_by("value", order).alias("best"), F.max("confidence").alias("confidence"), F.count("*").alias("n"))
