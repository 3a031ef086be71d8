"""What mentions in a text say together: couplings of models, tasks from several kinds of evidence, dimensions, captions grounded in entities, and the sentence that names an entity.

Mentions come from the gazetteer with their characters. What stands near what is told by sorting the places of a text and looking at the last one before and the first one after, never by pairing all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .gazetteer import found_names

# Words that couple two models, and words that tell dimensions.
COUPLERS = ("coupled with", "coupled to", "linked to", "linked with", "integrated with", "combined with")
DIMENSIONS = (
    ("1D", r"(?i)\b1[\s\-]?D\b|one[\s\-]?dimensional"), ("2D", r"(?i)\b2[\s\-]?D\b|two[\s\-]?dimensional"), ("3D", r"(?i)\b3[\s\-]?D\b|three[\s\-]?dimensional"),
    ("coupled_1D_2D", r"(?i)\bcoupled[\s\-]?1[\s\-]?D[\s\-]?2[\s\-]?D\b|1D[\s\-]?2D[\s\-]?coupled|1D\s+and\s+2D"),
)
# The relation of a region's kind to what its caption names.
GROUNDS = {"figure": ("HAS_FIGURE", "MENTIONS"), "table": ("HAS_TABLE", "REPORTS"), "equation": ("HAS_EQUATION", "GROUNDS_TO")}


def dimensions(texts: DataFrame) -> DataFrame:
    """(text_id, dimensions): an array in order; 1D and 2D together are coupled."""
    has = [F.coalesce(F.col("text").rlike(pattern), F.lit(False)) for _, pattern in DIMENSIONS]
    has[3] = has[3] | (has[0] & has[1])
    return texts.select("text_id", F.array_sort(F.array_compact(F.array(*[F.when(h, name) for h, (name, _) in zip(has, DIMENSIONS)]))).alias("dimensions"))


def couplings(texts: DataFrame, models: DataFrame, window: int) -> DataFrame:
    """(text_id, model_a, model_b, cue, start, end): two different models with a coupling word between them, each within `window` characters of it. models: phrase, name."""
    spark = texts.sparkSession
    cues = spark.createDataFrame([(c, c) for c in COUPLERS], "phrase string, name string")
    hits = found_names(texts, models.select("phrase", "name")).withColumn("cue", F.lit(False)).unionByName(found_names(texts, cues).withColumn("cue", F.lit(True)))
    order = Window.partitionBy("text_id").orderBy("start", "end")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(1, Window.unboundedFollowing)
    model = F.when(~F.col("cue"), F.struct("name", "start", "end"))
    placed = hits.withColumn("a", F.last(model, ignorenulls=True).over(before)).withColumn("b", F.first(model, ignorenulls=True).over(after)).filter("cue and a is not null and b is not null")
    near = placed.filter((F.col("start") - F.col("a.end") <= window) & (F.col("b.start") - F.col("end") <= window) & (F.col("a.name") != F.col("b.name")))
    return near.select("text_id", F.col("a.name").alias("model_a"), F.col("b.name").alias("model_b"), F.col("name").alias("cue"), F.col("a.start").alias("start"), F.col("b.end").alias("end"))


def tasks(texts: DataFrame, phrases: DataFrame, methods: DataFrame, coupled: DataFrame) -> DataFrame:
    """phrases: phrase, task, confidence; methods: phrase, name, task (that of its users); coupled: the couplings. (text_id, task, confidence, source), the best evidence of each task."""
    said = found_names(texts, phrases).select("text_id", "task", "confidence", F.when(F.col("confidence") > 0.9, "text_phrase").otherwise("text_keyword").alias("source"))
    used = found_names(texts, methods).select("text_id", "task", F.lit(0.85).alias("confidence"), F.lit("method_task_field").alias("source"))
    joint = coupled.select("text_id", F.lit("flood_inundation_mapping").alias("task"), F.lit(0.88).alias("confidence"), F.lit("coupling_context").alias("source"))
    best = F.max(F.struct("confidence", "source"))
    return said.unionByName(used).unionByName(joint).groupBy("text_id", "task").agg(best.alias("b")).select("text_id", "task", "b.*")


def region_graph(regions: DataFrame, phrases: DataFrame) -> DataFrame:
    """regions: region_id, paper_id, kind, caption; phrases: phrase, canonical_id. Edges (src, rel, dst, start, end): a paper to its regions, and a region to each entity its caption names, with the first place; other kinds are left out."""
    rel = lambda k: F.try_element_at(F.create_map(*[F.lit(x) for kind, rels in GROUNDS.items() for x in (kind, rels[k])]), F.col("kind"))
    known = regions.filter(F.col("kind").isin(*GROUNDS))
    owned = known.select(F.col("paper_id").cast("string").alias("src"), rel(0).alias("rel"), F.col("region_id").cast("string").alias("dst"), F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("end"))
    hits = found_names(known.select(F.col("region_id").alias("text_id"), F.col("caption").alias("text")), phrases.select("phrase", "canonical_id"))
    first = hits.groupBy("text_id", "canonical_id").agg(F.min(F.struct("start", "end")).alias("b"))
    named = first.join(known.select(F.col("region_id").alias("text_id"), "kind"), "text_id")
    return owned.unionByName(named.select(F.col("text_id").cast("string").alias("src"), rel(1).alias("rel"), F.col("canonical_id").alias("dst"), F.col("b.start").alias("start"), F.col("b.end").alias("end")))


def first_sentences(sentences: DataFrame, names: DataFrame) -> DataFrame:
    """sentences: text_id, ord, sentence; names: text_id, name. (text_id, name, ord, match): the first sentence that holds the name (exact), else the first that holds all its words, two at least (partial)."""
    met = names.join(sentences, "text_id")
    low, name = F.lower("sentence"), F.lower("name")
    words = F.filter(F.split(name, r"\s+"), lambda w: w != "")
    partial = (F.size(words) >= 2) & F.forall(words, lambda w: low.contains(w))
    ranked = met.withColumn("rank", F.when(low.contains(name), 0).when(partial, 1)).filter("rank is not null")
    best = ranked.groupBy("text_id", "name").agg(F.min(F.struct("rank", "ord")).alias("b"))
    return best.select("text_id", "name", F.col("b.ord").alias("ord"), F.when(F.col("b.rank") == 0, "exact").otherwise("partial").alias("match"))
