"""Registries of entities: sources merged into one row for each id, and the statistics of a registry.

Nothing is collected by id before its items are told apart: list items are grouped by id, field and form, so that an id repeated in many sources costs one small row a task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .registry_checks import PREFIXES, hierarchy

LISTS = ("used_for", "inputs", "outputs", "limitations", "related", "contexts", "aliases")
# The file that ids of a type are kept in; all other types are concepts.
FILES = {"method": "methods", "sensor": "sensors", "metric": "metrics", "data": "data_sources"}


def _looked_up(table: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key)


def merged_sources(sources: DataFrame, lists: Sequence[str] = LISTS, patched: DataFrame | None = None) -> DataFrame:
    """sources: ord (which row came first; unique), id, type, definition, domain, source and the lists (arrays). One row for each id: id, type, definition, domain, sources, the lists, file.

    The longest definition stays, of equals the first; lists are united, of items alike but for case and blanks at their ends the first stays; the first domain that isn't empty and all sources in order of
    arrival. An id's prefix tells its type and file, whatever the rows say, so that nothing is merged across types. patched: ord, id, alias; added after all others, but for aliases that are there
    already as they stand, and for ids that no source has. Null ids are left out; null lists and items are empty.
    """
    rows = sources.filter("id is not null")
    filled = lambda c: F.when(F.coalesce(c, F.lit("")) != "", F.col(c))
    longest = F.max_by(filled("definition"), F.when(filled("definition").isNotNull(), F.struct(F.length("definition"), -F.col("ord"))))
    base = rows.groupBy("id").agg(
        F.coalesce(longest, F.lit("")).alias("definition"), F.min_by(filled("domain"), F.when(filled("domain").isNotNull(), F.col("ord"))).alias("domain"), F.min_by("type", "ord").alias("_said"),
    )
    item = lambda field: F.transform(F.coalesce(field, F.array().cast("array<string>")), lambda x, k: F.struct(F.lit(field).alias("field"), F.struct(F.lit(0).alias("late"), F.col("ord").alias("ord"), k.alias("k")).alias("at"), x.alias("x")))
    came = F.array(F.struct(F.lit("sources").alias("field"), F.struct(F.lit(0).alias("late"), F.col("ord").alias("ord"), F.lit(0).alias("k")).alias("at"), F.col("source").alias("x")))
    items = rows.select("id", F.explode(F.concat(came, *map(item, lists))).alias("i")).select("id", "i.*").filter("x is not null")
    form = F.when(F.col("field") == "sources", F.col("x")).otherwise(F.trim(F.lower("x")))
    once = items.groupBy("id", "field", form.alias("form")).agg(F.min(F.struct("at", "x")).alias("b"))
    if patched is not None:
        have = once.filter("field = 'aliases'").select("id", F.col("b.x").alias("alias"))
        new = patched.filter("alias is not null").groupBy("id", "alias").agg(F.min("ord").alias("ord")).join(have, ["id", "alias"], "left_anti")
        once = once.unionByName(new.select("id", F.lit("aliases").alias("field"), F.col("alias").alias("form"), F.struct(F.struct(F.lit(1).alias("late"), F.col("ord").alias("ord"), F.lit(0).alias("k")).alias("at"), F.col("alias").alias("x")).alias("b")))
    held = lambda field: F.transform(F.array_sort(F.collect_list(F.when(F.col("field") == field, F.col("b")))), lambda b: b["x"])
    together = once.groupBy("id").agg(*[held(f).alias(f) for f in ("sources", *lists)])
    prefix = F.substring_index("id", ".", 1)
    return base.join(together, "id", "left").select(
        "id", F.coalesce(_looked_up(PREFIXES, prefix), "_said").alias("type"), "definition", "domain", *[F.coalesce(f, F.array().cast("array<string>")).alias(f) for f in ("sources", *lists)], F.coalesce(_looked_up(FILES, prefix), F.lit("concepts")).alias("file"),
    )


def statistics(entities: DataFrame) -> DataFrame:
    """entities: id (unique), type, type_group, definition, aliases, sources (arrays), parent_id, is_generic. Rows (what, key, value) on the whole registry.

    what: entities, type, type_group, source (counts by key), aliases (min, max, mean, median, none, all), definition (with, without, percent), hierarchy (roots, children, deepest, parents), generic (count) and
    grouped (percent of a type's entities that have a group). An entity whose way up runs into a cycle counts as a child without depth; a parent that no entity has is one step up, but no entity.
    """
    c, real = F.col, lambda x: x.cast("double")
    rows = entities.select("id", F.coalesce("type", F.lit("unknown")).alias("type"), F.when(c("type_group") != "", c("type_group")).alias("type_group"), (F.trim(F.coalesce("definition", F.lit(""))) != "").alias("told"), F.coalesce(F.size("aliases"), F.lit(0)).alias("n"), "sources", "parent_id", F.coalesce("is_generic", F.lit(False)).alias("generic"))
    rows = rows.withColumn("n", F.greatest("n", F.lit(0)))

    def unpivoted(df: DataFrame, what: str, values: dict[str, Column]) -> DataFrame:
        told = df.agg(F.array(*[F.struct(F.lit(k).alias("key"), real(v).alias("value")) for k, v in values.items()]).alias("v"))
        return told.select(F.lit(what).alias("what"), F.explode("v").alias("v")).select("what", "v.*")

    count = F.count(F.lit(1))
    share = lambda cond: F.when(count > 0, F.round(F.count_if(cond) / count * 100, 1)).otherwise(F.lit(0.0))
    per = lambda what, key, value: rows.groupBy(key.alias("key")).agg(real(value).alias("value")).select(F.lit(what).alias("what"), "key", "value")
    zero = lambda x: F.coalesce(x, F.lit(0))
    lengths = rows.groupBy("n").agg(count.alias("m"))  # the median from counts of lengths, not from all rows
    out = [
        unpivoted(rows, "entities", {"count": count, "generic": F.count_if("generic")}),
        unpivoted(rows, "definition", {"with": F.count_if("told"), "without": F.count_if(~c("told")), "percent": share(c("told"))}),
        unpivoted(lengths, "aliases", {"min": zero(F.min("n")), "max": zero(F.max("n")), "mean": zero(F.round(F.sum(c("n") * c("m")) / F.sum("m"), 2)), "median": zero(F.percentile("n", F.lit(0.5), c("m"))), "none": zero(F.sum(F.when(c("n") == 0, c("m")))), "all": zero(F.sum(c("n") * c("m")))}),
        per("type", c("type"), count), per("type_group", F.coalesce("type_group", F.lit("unassigned")), count), per("grouped", c("type"), share(c("type_group").isNotNull())),
    ]
    out.append(rows.select(F.explode("sources").alias("key")).filter("key is not null").groupBy("key").agg(real(count).alias("value")).select(F.lit("source").alias("what"), "key", "value"))
    ups = entities.select("id", F.when(c("parent_id") != "", c("parent_id")).alias("parent_id"))
    unknown = ups.filter("parent_id is not null").select(c("parent_id").alias("id")).distinct().join(ups.select("id"), "id", "left_anti")
    deep = hierarchy(ups.unionByName(unknown.withColumn("parent_id", F.lit(None).cast("string")))).join(unknown, "id", "left_anti")
    out.append(unpivoted(deep, "hierarchy", {"roots": F.count_if(c("depth") == 0), "children": F.count_if(F.coalesce(c("depth") > 0, F.lit(True))), "deepest": zero(F.max("depth"))}))
    out.append(unpivoted(rows.filter("parent_id <> ''").select("parent_id").distinct(), "hierarchy", {"parents": count}))
    whole = out[0]
    for more in out[1:]:
        whole = whole.unionByName(more)
    return whole
