"""Semantic rules over figures, tables and equations: each rule is a condition, and what it adds. All rules that hold apply, each once."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R


@dataclass(frozen=True)
class Rule:
    name: str
    gain: float
    holds: Callable[[], Column]
    roles: tuple[str, ...] = ()
    tasks: tuple[str, ...] = ()


def _kind(*kinds: str) -> Column:
    return F.col("kind").isin(*kinds)


def _type(*types: str) -> Column:
    return F.col("semantic_type").isin(*types)


def _has(column: str, pattern: str) -> Column:
    return R.matches(F.col(column), pattern)


# Names, gains, conditions, roles and tasks of the rules.
RULES = (
    Rule("R01_hydrograph_in_results", 0.10, lambda: _kind("figure") & _type("hydrograph") & _has("section", r"\bresult"), ("model_output",)),
    Rule("R02_simulated_in_caption", 0.12, lambda: _kind("figure") & _has("caption", r"\bsimulated\b"), ("model_output",)),
    Rule("R03_observed_vs_simulated", 0.12, lambda: _kind("figure", "table") & _has("caption", r"\bobserved\b") & _has("caption", r"\bsimulated\b"), ("observed_vs_simulated", "model_validation")),
    Rule("R04_uncertainty_figure", 0.08, lambda: _kind("figure") & _has("caption", r"\b(uncertainty|confidence.interval|prediction.band|ensemble.spread)\b"), ("uncertainty_visualization",)),
    Rule("R05_satellite_in_study_area", 0.10, lambda: _kind("figure") & _type("satellite_image") & _has("section", r"\b(study.area|case.study|site|watershed)\b"), ("remote_sensing_input", "study_area_definition")),
    Rule("R06_scatter_with_r2", 0.08, lambda: _kind("figure") & _type("scatter_plot") & _has("caption", r"\b(r[²2]|r\s*=|correlation|pearson)\b"), ("evaluation_visualization",)),
    Rule("R07_metrics_table_multi_model", 0.12, lambda: _kind("table") & _type("metrics_table", "comparison_table") & (F.size("models") >= 2), ("model_comparison",)),
    Rule("R08_metrics_table_in_results", 0.08, lambda: _kind("table") & _type("metrics_table") & _has("section", r"\bresult"), ("model_validation",)),
    Rule("R09_param_table_in_methods", 0.08, lambda: _kind("table") & _type("parameter_table") & _has("section", r"\b(method|calibrat|model.setup)\b"), ("model_calibration",)),
    Rule("R10_saint_venant_hec_ras", 0.15, lambda: _kind("equation") & _has("caption", r"\bsaint.venant\b") & _has("around", r"\bhec.?ras\b")),
    Rule("R11_scs_cn_rainfall_runoff", 0.10, lambda: _kind("equation") & _has("caption", r"\b(scs.?cn|curve.number)\b"), (), ("rainfall_runoff_modeling", "flood_forecasting")),
    Rule("R12_manning_hydraulic", 0.10, lambda: _kind("equation") & _has("caption", r"\bmanning") & _has("around", r"\b(channel|river|flood.plain|floodplain)\b"), ("physical_law",), ("hydraulic_modeling",)),
    Rule("R13_conclusion_figure", 0.05, lambda: _kind("figure") & _has("section", r"\b(conclus|summary|recommendation)\b"), ("validation",)),
    Rule("R14_flood_figure_task", 0.06, lambda: _kind("figure") & _type("flood_extent_map", "hydrograph"), (), ("flood_inundation",)),
    Rule("R15_rs_vegetation_figure", 0.06, lambda: _kind("figure") & _has("caption", R.SATELLITE_SIGNALS) & _has("caption", r"\b(ndvi|ndwi|vegetation|drought|land.use|lulc|land.cover)\b"), (), ("lulc_classification", "drought_monitoring")),
)


def typed(objects: DataFrame) -> DataFrame:
    """Adds semantic_type, its score, and the models named in the caption."""
    caption = F.col("caption")
    found = F.when(_kind("figure"), R.first_match(caption, R.FIGURE_RULES, R.FIGURE_DEFAULT)).when(_kind("table"), R.first_match(caption, R.TABLE_RULES, R.TABLE_DEFAULT)).otherwise(R.first_match(caption, R.EQUATION_RULES, R.EQUATION_DEFAULT))
    models = F.array_distinct(F.transform(F.regexp_extract_all(caption, F.lit(f"(?i){R.MODEL_SIGNALS}"), F.lit(1)), F.upper))
    return objects.withColumn("t", found).withColumn("models", models).withColumn("semantic_type", F.col("t.label")).withColumn("score", F.col("t.score")).drop("t")


def annotated(objects: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """objects: object_id, kind, caption, section, around (null counts as empty). Adds fired (names in order), roles, tasks and confidence (the type's score and all gains, at most 1)."""
    rows = typed(objects)
    fired = F.filter(F.array(*[F.when(r.holds(), F.lit(k)) for k, r in enumerate(rules)]), lambda k: k.isNotNull())
    rows = rows.withColumn("f", fired)
    of = lambda values: F.transform("f", lambda k: F.element_at(F.array(*values), k + 1))
    texts = lambda xs: F.array(*[F.lit(x) for x in xs]).cast("array<string>")
    gain = F.aggregate(of([F.lit(r.gain) for r in rules]), F.lit(0.0), lambda a, x: a + x)
    return rows.select(
        *[c for c in rows.columns if c != "f"], of([F.lit(r.name) for r in rules]).alias("fired"), F.array_distinct(F.flatten(of([texts(r.roles) for r in rules]))).alias("roles"),
        F.array_distinct(F.flatten(of([texts(r.tasks) for r in rules]))).alias("tasks"), F.least(F.lit(1.0), F.col("score") + gain).alias("confidence"),
    )
