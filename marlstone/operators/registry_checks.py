"""Checks of an entity registry: fields, ids, names and aliases of each entity, collisions between entities, and its hierarchy as a graph.

Entities: id (unique), display_name, type, aliases (array), parent_id, is_generic. Every check is a select or a grouping by what may collide, so that nothing is compared pair by pair; hierarchies are closed by
pointer jumping: in a round every node looks up its ancestor's ancestor, so rounds grow with the logarithm of the depth.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import slug
from ..sources.tables import stored

# The type that an id's prefix stands for.
PREFIXES = {"method": "method", "sensor": "sensor", "metric": "metric", "data": "data", "concept": "concept", "org": "organization", "system": "system", "parameter": "parameter", "uncertainty": "uncertainty"}
ID_FORM = r"^[a-z][a-z0-9_]*\.[a-z][a-z0-9_]*$"


def _suffix(c: Column) -> Column:
    return F.regexp_replace(c, r"^[^.]*\.", "")


def violations(entities: DataFrame, generic: DataFrame) -> DataFrame:
    """(code, level, entity_id, subject) of V01 to V08; generic: id of the entities that should carry the flag."""
    c = F.col
    told = lambda rows, code, level, subject: rows.select(F.lit(code).alias("code"), F.lit(level).alias("level"), c("id").alias("entity_id"), subject.cast("string").alias("subject"))
    empty = lambda name: F.coalesce(c(name), F.lit("")) == ""
    missing = F.array_compact(F.array(F.when(empty("id"), "id"), F.when(empty("display_name"), "display_name"), F.when(empty("type"), "type"), F.when(F.coalesce(F.size("aliases"), F.lit(0)) <= 0, "aliases")))
    out = [told(entities.select("id", F.explode(missing).alias("field")), "V01", "ERROR", c("field")), told(entities.filter(~c("id").rlike(ID_FORM)), "V02", "ERROR", c("id"))]
    prefix = F.substring_index("id", ".", 1)
    of = F.try_element_at(F.create_map(*[F.lit(x) for pair in PREFIXES.items() for x in pair]), prefix)
    out += [told(entities.filter(of.isNull()), "V03", "WARNING", prefix), told(entities.filter(of.isNotNull() & ~of.eqNullSafe(c("type"))), "V03", "ERROR", F.concat_ws(" is not ", F.coalesce("type", F.lit("nothing")), of))]
    ids = entities.select(c("id").alias("known"))
    out.append(told(entities.filter("parent_id <> ''").join(ids, c("parent_id") == c("known"), "left_anti"), "V04", "ERROR", c("parent_id")))
    out.append(told(entities.filter(F.trim(F.coalesce("display_name", F.lit(""))) == ""), "V05", "ERROR", F.lit("display_name")))
    alias = entities.select("id", "display_name", F.explode("aliases").alias("alias"))
    out.append(told(alias.filter((slug(c("alias")) == slug(c("id"))) | (slug(c("alias")) == slug(F.coalesce("display_name", F.lit(""))))), "V06", "WARNING", c("alias")))
    out.append(told(entities.filter(~F.coalesce("is_generic", F.lit(False))).join(generic.select(c("id").alias("known")), c("id") == c("known"), "left_semi"), "V07", "WARNING", c("id")))
    name = F.lower(F.trim(F.coalesce("display_name", F.lit(""))))
    keyed = entities.select("id", F.coalesce("type", F.lit("")).alias("type"), name.alias("name"))
    shared = keyed.groupBy("type", "name").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    out.append(told(keyed.join(shared, ["type", "name"]), "V08", "WARNING", c("name")))
    return reduce(DataFrame.unionByName, out)


def collisions(entities: DataFrame) -> DataFrame:
    """(code, level, slug, entity_id, n) of C01 (a slug claimed by several entities, by id, name or alias), C02 (a name shared within a type) and C03 (an id's slug that is another one's alias); a row for each entity in it, n: how many are."""
    c = F.col
    name = slug(F.coalesce("display_name", F.lit("")))
    claims = entities.select("id", F.explode(F.array_distinct(F.concat(F.array(slug(c("id")), slug(_suffix(c("id"))), name), F.transform(F.coalesce("aliases", F.array().cast("array<string>")), slug)))).alias("slug")).filter("slug <> ''")
    many = claims.groupBy("slug").agg(F.count("*").alias("n")).filter("n > 1")
    first = claims.join(many, "slug").select(F.lit("C01").alias("code"), F.lit("ERROR").alias("level"), "slug", c("id").alias("entity_id"), "n")
    named = entities.select("id", F.coalesce("type", F.lit("unknown")).alias("type"), name.alias("slug")).filter("slug <> ''")
    twice = named.groupBy("type", "slug").agg(F.count("*").alias("n")).filter("n > 1")
    second = named.join(twice, ["type", "slug"]).select(F.lit("C02").alias("code"), F.lit("WARNING").alias("level"), "slug", c("id").alias("entity_id"), "n")
    owned = entities.select(c("id").alias("owner"), F.explode(F.array_distinct(F.transform("aliases", slug))).alias("slug"))
    owners = owned.groupBy("slug").agg(F.count("*").alias("owners"))
    own = owned.select("slug", c("owner").alias("id"), F.lit(1).cast("long").alias("own"))
    shadow = entities.select("id", slug(_suffix(c("id"))).alias("slug")).join(owners, "slug").join(own, ["slug", "id"], "left").withColumn("n", c("owners") - F.coalesce("own", F.lit(0))).filter("n > 0")
    third = shadow.select(F.lit("C03").alias("code"), F.lit("WARNING").alias("level"), "slug", c("id").alias("entity_id"), "n")
    return first.unionByName(second).unionByName(third)


def hierarchy(entities: DataFrame) -> DataFrame:
    """(id, root, depth, in_cycle) of each entity: its topmost ancestor and how many steps it is up to it; an unknown parent ends the way there. Without root where the way up runs into a cycle."""
    ids = entities.select(F.col("id").alias("known"))
    links = entities.select("id", "parent_id").join(ids, F.col("parent_id") == F.col("known"), "left")
    rows = stored(links.select("id", F.coalesce("known", "id").alias("up"), F.when(F.col("known").isNull(), 0).otherwise(1).cast("long").alias("steps"), F.col("known").isNull().alias("done")), "hierarchy")
    reach, most = 1, rows.count()
    while not rows.filter("not done").isEmpty() and reach <= 2 * most:
        above = rows.select(F.col("id").alias("at"), F.col("up").alias("next"), F.col("steps").alias("more"), F.col("done").alias("there"))
        rows = stored(rows.join(above, F.col("up") == F.col("at")).select("id", F.when(F.col("done"), F.col("up")).otherwise(F.col("next")).alias("up"), (F.col("steps") + F.when(F.col("done"), 0).otherwise(F.col("more"))).alias("steps"), (F.col("done") | F.col("there")).alias("done")), "hierarchy")
        reach *= 2
    return rows.select("id", F.when(F.col("done"), F.col("up")).alias("root"), F.when(F.col("done"), F.col("steps")).alias("depth"), (~F.col("done")).alias("in_cycle"))
