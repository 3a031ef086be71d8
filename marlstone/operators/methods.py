"""Methods that a text really uses, with what a registry tells of them: the work they imply, models coupled with each other, hybrids.

Registry: name (unique), category, subcategory, dimension, tasks, partners and components (arrays of strings; partners are names). Phrases: phrase, name. Defined cases: a name that the
registry lacks is found but implies only what its name does; null arrays are empty; a method named several times in a text counts once, by its first place in use; a null or empty text has none.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .checks import really_used
from .gazetteer import found_names
from .mentions import COUPLERS

CONFIDENCE = 0.88
# The work that categories and tasks stand for, and, where neither says anything, parts of names.
BY_CATEGORY = {
    "physical_based": "flood_modeling_pipeline", "time_series": "time_series_forecasting_pipeline", "machine_learning": "ml_prediction_pipeline", "hybrid": "ml_prediction_pipeline",
    "remote_sensing": "flood_mapping_pipeline", "fuzzy_logic": "fuzzy_inference_pipeline",
}
BY_TASK = {
    "flood_forecasting": "flood_forecasting_pipeline", "water_level_forecasting": "flood_forecasting_pipeline", "flood_inundation_mapping": "flood_mapping_pipeline", "flood_extent_mapping": "flood_mapping_pipeline",
}
BY_NAME = {
    "flood_modeling_pipeline": ("runoff", "routing", "hec", "swat", "lisflood", "precipitation", "hydrograph"), "drought_vegetation_pipeline": ("ndvi", "evi", "savi", "vci", "pdsi", "spi"),
    "terrain_analysis_pipeline": ("dem", "slope", "twi", "hand", "srtm", "dtm"),
}
CHAINING = (*COUPLERS, "chained with")
WAVELETS, LEARNERS = ("wavelet", "wt", "dwt", "swt", "wa-"), ("lstm", "ann", "svr", "mlp", "rbf")


def used_methods(texts: DataFrame, phrases: DataFrame, around: int = 200) -> DataFrame:
    """texts: text_id, text. (text_id, name, at, evidence, confidence): the first place of each method with a cue of use near it and none of being only spoken of."""
    hits = found_names(texts, phrases.select("phrase", "name")).join(texts, "text_id")
    begin = F.greatest(F.col("start") - around, F.lit(0))
    near = F.trim(F.regexp_replace(F.substring("text", begin + 1, F.col("end") + around - begin), r"\s+", " "))
    found = really_used(hits.select("text_id", "name", F.col("start").alias("at"), near.alias("context")))
    return found.select("text_id", "name", "at", F.col("context").alias("evidence"), F.lit(CONFIDENCE).alias("confidence"))


def _looked_up(table: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key)


def _has(name: Column, parts: tuple[str, ...]) -> Column:
    return reduce(Column.__or__, [name.contains(p) for p in parts])


def implied_work(found: DataFrame, registry: DataFrame) -> DataFrame:
    """(text_id, pipelines): the sorted work that a text's methods stand for by category and tasks; where these say nothing at all, by parts of their names. Texts without either are left out."""
    rows = found.select("text_id", "name").distinct().join(registry.select("name", "category", "tasks"), "name", "left")
    told = F.array_compact(F.concat(F.array(_looked_up(BY_CATEGORY, F.col("category"))), F.transform(F.coalesce("tasks", F.array().cast("array<string>")), lambda x: _looked_up(BY_TASK, x))))
    low = F.lower("name")
    guessed = F.array_compact(F.array(*[F.when(_has(low, parts), F.lit(work)) for work, parts in BY_NAME.items()]))
    all_of = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_set(c))))
    per = rows.groupBy("text_id").agg(all_of(told).alias("told"), all_of(guessed).alias("guessed"))
    return per.select("text_id", F.when(F.size("told") > 0, F.col("told")).otherwise(F.col("guessed")).alias("pipelines")).filter("size(pipelines) > 0")


def known_couplings(texts: DataFrame, found: DataFrame, registry: DataFrame) -> DataFrame:
    """(text_id, model_a, model_b, coupling_type): methods of a text of which the registry calls the second a partner of the first, if the text has a word that couples."""
    low = F.lower(F.regexp_replace("text", r"\s+", " "))
    coupling = texts.filter(_has(low, CHAINING)).select("text_id")
    facts = registry.select("name", "subcategory", "dimension", "partners")
    here = found.select("text_id", "name").distinct().join(coupling, "text_id", "left_semi").join(facts, "name")
    first = here.select("text_id", F.col("name").alias("model_a"), F.col("subcategory").alias("_sa"), F.col("dimension").alias("_da"), F.explode(F.array_distinct("partners")).alias("model_b"))
    second = here.select("text_id", F.col("name").alias("model_b"), F.col("subcategory").alias("_sb"), F.col("dimension").alias("_db"))
    kind = F.when((F.col("_sa") == "hydrological") & (F.col("_sb") == "hydrodynamic"), "hydrological_hydrodynamic").when((F.col("_da") == "1D") & (F.col("_db") == "2D"), "1D_2D").otherwise("detected")
    return first.join(second, ["text_id", "model_b"]).select("text_id", "model_a", "model_b", kind.alias("coupling_type"))


def hybrids(found: DataFrame, registry: DataFrame) -> DataFrame:
    """(text_id, name, subcategory, components, source): hybrids by the registry, and one inferred where a text uses a wavelet and a learner; its components are all methods of the text."""
    names = found.select("text_id", "name").distinct()
    listed = names.join(registry.filter("category = 'hybrid'").select("name", "subcategory", "components"), "name")
    known = listed.select("text_id", "name", "subcategory", F.coalesce("components", F.array().cast("array<string>")).alias("components"), F.lit("registry").alias("source"))
    low = F.lower("name")
    per = names.groupBy("text_id").agg(F.bool_or(_has(low, WAVELETS)).alias("w"), F.bool_or(_has(low, LEARNERS)).alias("l"), F.array_sort(F.collect_set("name")).alias("components")).filter("w and l")
    return known.unionByName(per.select("text_id", F.lit("wavelet_ml_hybrid_inferred").alias("name"), F.lit("wavelet_ml").alias("subcategory"), "components", F.lit("inferred").alias("source")))
