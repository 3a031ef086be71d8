"""Names to entities: a table of aliases and a cascade of ways to find a mention in it.

All ways are equi joins of slugs: a mention's candidates are made in its row, each with its place in the cascade, and the first that is an alias of a compatible entity wins. Nothing is compared
with every alias. Defined cases: null and empty mentions are unknown; of entities with one alias the one given last has it; an empty table of aliases leaves all unknown.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import slug

# Words at the end of a mention that say what kind of thing it is.
NOISE = (
    "model", "algorithm", "method", "approach", "technique", "system", "index", "data", "analysis", "sar", "imagery", "image", "sensor", "satellite", "mapping", "based", "network",
    "classifier", "detector", "estimator",
)


def alias_table(entities: DataFrame) -> DataFrame:
    """entities: entity_id, ord, name, aliases (array). (alias, entity_id): slugs of the id, the id after its first point, the name and all aliases; the entity of greatest ord has an alias that several claim."""
    said = F.concat(F.array("entity_id", F.regexp_replace("entity_id", r"^[^.]*\.", ""), F.coalesce("name", F.lit(""))), F.coalesce("aliases", F.array().cast("array<string>")))
    rows = entities.select("entity_id", "ord", F.explode(F.transform(said, lambda x: slug(x))).alias("alias")).filter("alias <> ''")
    return rows.groupBy("alias").agg(F.max_by("entity_id", "ord").alias("entity_id"))


def candidates(mention: Column) -> tuple[Column, Column]:
    """(words of the slug, to be named w; from w an array of (step, rank, alias)): the slug; without its last words while these are noise; its parts of fewer words, longest and leftmost first, two words at least."""
    words = F.split(slug(mention), "_")
    noise = "array(" + ", ".join(f"'{w}'" for w in NOISE) + ")"
    made = F.expr(
        f"""transform(array(w), w -> concat(
            array(struct(1 as step, 0 as rank, array_join(w, '_') as alias)),
            transform(filter(sequence(1, greatest(size(w) - 1, 1)), k -> k < size(w) and forall(slice(w, size(w) - k + 1, k), x -> array_contains({noise}, x))), k -> struct(2 as step, k as rank, array_join(slice(w, 1, size(w) - k), '_') as alias)),
            flatten(transform(filter(sequence(1, greatest(size(w) - 1, 1)), d -> size(w) - d >= 2), d -> transform(sequence(1, d + 1), i -> struct(3 as step, d * 1000 + i as rank, array_join(slice(w, i, size(w) - d), '_') as alias))))
        ))[0]"""
    )
    return F.when(slug(mention) != "", words), made


def resolved(mentions: DataFrame, aliases: DataFrame, compatible: Column | None = None) -> DataFrame:
    """mentions: mention_id, mention and what `compatible` needs. mention_id, entity_id and how (exact, truncated, phrase, unknown).

    compatible: a condition over a mention's columns and entity_id; candidates that fail it are passed over."""
    words, made = candidates(F.col("mention"))
    rows = mentions.withColumn("w", words).withColumn("c", F.when(F.col("w").isNotNull(), made))
    hits = rows.select(*mentions.columns, F.explode("c").alias("c")).join(aliases, F.col("c.alias") == F.col("alias"))
    if compatible is not None:
        hits = hits.filter(compatible)
    best = hits.groupBy("mention_id").agg(F.min(F.struct("c.step", "c.rank", "entity_id")).alias("b"))
    how = F.when(F.col("b.step") == 1, "exact").when(F.col("b.step") == 2, "truncated").when(F.col("b.step") == 3, "phrase").otherwise("unknown")
    return mentions.select("mention_id").join(best, "mention_id", "left").select("mention_id", F.col("b.entity_id").alias("entity_id"), how.alias("how"))


def contained(texts: DataFrame, aliases: DataFrame, most: int = 5, longest: int = 6) -> DataFrame:
    """texts: text_id, text. For each the `most` entities with the longest alias that is a run of whole words of the text (longest words at most); equal lengths by entity_id.

    Runs of words are joined with the aliases; a search of every alias in every text isn't needed."""
    words = F.split(slug(F.col("text")), "_")
    runs = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(longest)), lambda n: F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - n + 1, F.lit(1))), lambda i: F.array_join(F.slice("w", i, n), "_"))))
    rows = texts.select("text_id", words.alias("w")).select("text_id", F.explode(F.array_distinct(runs)).alias("alias"))
    hits = rows.join(aliases, "alias").groupBy("text_id", "entity_id").agg(F.max(F.length("alias")).alias("n"))
    ranked = hits.groupBy("text_id").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "entity_id"))), 1, most).alias("b"))  # as many as a text has words
    return ranked.select("text_id", F.posexplode("b").alias("k", "x")).select("text_id", (F.col("k") + 1).alias("rank"), F.col("x.entity_id").alias("entity_id"))
