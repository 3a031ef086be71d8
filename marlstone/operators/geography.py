"""Places of a study from its text: countries, regions and rivers by names, rivers judged by what is said around them, coordinates, scope, and how sure all this is."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .gazetteer import found_names

# Names that tell a country, in the order in which the first one found counts as the study's.
COUNTRIES = {
    "Ukraine": "ukraine, ukrainian, kyiv, kherson, kakhovka, zakarpattia, carpathian, carpathians", "Poland": "poland, polish", "Germany": "germany, german", "France": "france, french",
    "Italy": "italy, italian", "Spain": "spain, spanish", "Portugal": "portugal, portuguese", "Netherlands": "netherlands, dutch", "Belgium": "belgium", "Austria": "austria", "Switzerland": "switzerland",
    "Slovenia": "slovenia", "Croatia": "croatia", "Hungary": "hungary", "Czech Republic": "czech", "Slovakia": "slovakia", "Romania": "romania", "Bulgaria": "bulgaria", "Greece": "greece",
    "Turkey": "turkey", "UK": "uk, united kingdom, england, scotland, wales", "Ireland": "ireland", "USA": "usa, united states, louisiana, california, texas, florida", "Canada": "canada",
    "Mexico": "mexico", "Brazil": "brazil", "Argentina": "argentina", "Chile": "chile", "Peru": "peru", "India": "india, kerala", "China": "china", "Japan": "japan", "South Korea": "korea",
    "Vietnam": "vietnam", "Thailand": "thailand", "Indonesia": "indonesia", "Malaysia": "malaysia", "Pakistan": "pakistan", "Bangladesh": "bangladesh", "Uzbekistan": "uzbekistan",
    "Kazakhstan": "kazakhstan", "Iran": "iran", "Iraq": "iraq", "Australia": "australia, new south wales, queensland", "New Zealand": "new zealand", "South Africa": "south africa", "Egypt": "egypt",
    "Morocco": "morocco", "Madagascar": "madagascar", "Nigeria": "nigeria", "Philippines": "philippines, luzon",
}
# Regions by name.
REGIONS = {
    "Luzon": "luzon", "Cagayan Valley": "cagayan valley", "Northern Philippines": "northern philippines", "Steppe zone": "steppe zone", "Forest-steppe zone": "forest steppe, foreststeppe",
    "Ukrainian Carpathians": "ukrainian carpathians, carpathians", "Crimean Mountains": "crimean mountains", "Kyiv Oblast": "kyiv oblast", "Bucha district": "bucha district",
    "Zakarpattia": "zakarpattia, transcarpathia", "Kherson": "kherson", "Krka floodplain": "krka river floodplain, krka floodplain", "Lower Krka": "lower krka", "Krakovo forest": "krakovo forest",
    "Kerala": "kerala", "Fishlake": "fishlake", "Pontypridd": "pontypridd", "Rhondda Cynon Taf": "rhondda cynon taf",
}
# Where a river lies.
RIVERS = {
    "Dnipro": "Ukraine", "Dnieper": "Ukraine", "Prut": "Ukraine/Romania", "Dniester": "Ukraine/Moldova", "Tisza": "Ukraine/Hungary", "Southern Bug": "Ukraine", "Desna": "Ukraine", "Moshchunka": "Ukraine",
    "Danube": "Multiple", "Rhine": "Germany/France/Netherlands", "Elbe": "Germany/Czech Republic", "Seine": "France", "Loire": "France", "Thames": "UK", "Po": "Italy", "Ebro": "Spain",
    "Tagus": "Spain/Portugal", "Duero": "Spain/Portugal", "Carrion": "Spain", "Krka": "Slovenia", "Sava": "Slovenia/Croatia", "Drava": "Austria/Slovenia/Croatia", "Vistula": "Poland", "Oder": "Germany/Poland",
    "Ganges": "India/Bangladesh", "Indus": "India/Pakistan", "Yangtze": "China", "Yellow River": "China", "Mekong": "Multiple", "Irrawaddy": "Myanmar", "Mississippi": "USA", "Colorado": "USA",
    "Amazon": "Brazil/Peru", "Orinoco": "Venezuela", "Parana": "Argentina/Brazil", "Nile": "Multiple", "Congo": "DR Congo", "Niger": "Multiple", "Zambezi": "Multiple", "Darling": "Australia",
    "Murray": "Australia", "Cagayan": "Philippines", "Cagayan River": "Philippines",
}
# Rivers known without the word River after them, in this spelling.
KNOWN_RIVERS = ("Dnipro", "Dnieper", "Prut", "Dniester", "Danube", "Tisza", "Moshchunka", "Krka", "Sava", "Darling", "Carrion", "Duero", "Indus", "Ganges")
# Words around a river that tell a citation, and words that tell the study's own place.
CITED = ("et al", "ismail (", "modi (", "by adopting", "modelled by", "previous study", "studied by", "proposed by", "introduced by", "according to", "in contrast to", "in the study of")
STUDIED = (
    "study area", "study basin", "study watershed", "located in", "situated in", "the watershed", "our study", "this study", "case study", "urban catchment", "the basin", "river basin is",
    "study site", "the study", "research area",
)
# Words that tell the scope of the data.
SCOPES = {"global": ("global coverage", "earth's entire surface", "global scale"), "multi_site": ("multiple flood images", "hundreds of", "eight data sets"), "global_satellite_archive": ("modis archive", "earth engine")}
AROUND = 120
_NAMED = r"\b([A-Z][a-zA-Z\-]+(?:\s+[A-Z][a-zA-Z\-]+){0,3})\s+River\b"
_KNOWN = rf"\b(?:{'|'.join(KNOWN_RIVERS)})\b"
_DEGREES = r"(\d{2})[°\s]+(\d{2}).*?N.*?(\d{2})[°\s]+(\d{2}).*?E"
_DECIMAL = r"(-?\d{1,2}\.\d+)\s*°?\s*([NS]?)\s*,\s*(-?\d{1,3}\.\d+)\s*°?\s*([EW]?)"


def phrases_of(spark: SparkSession, lists: dict[str, str], kind: str) -> DataFrame:
    """(phrase, name, ord, kind) of a table of names."""
    return spark.createDataFrame([(p, name, k, kind) for k, (name, listed) in enumerate(lists.items()) for p in listed.split(", ")], "phrase string, name string, ord int, kind string")


def places(texts: DataFrame) -> DataFrame:
    """(text_id, kind, name, ord, start, end, confidence): of each country and region the first place in the text that names it."""
    spark = texts.sparkSession
    found = [found_names(texts, phrases_of(spark, lists, kind)).withColumn("confidence", F.lit(sure)) for lists, kind, sure in ((COUNTRIES, "country", 0.75), (REGIONS, "region", 0.9))]
    rows = found[0].unionByName(found[1])
    return rows.groupBy("text_id", "kind", "name", "ord").agg(F.min(F.struct("start", "end", "confidence")).alias("b")).select("text_id", "kind", "name", "ord", "b.*")


def _any_of(text, words):
    return F.exists(F.array(*map(F.lit, words)), lambda w: text.contains(w))


def rivers(texts: DataFrame) -> DataFrame:
    """(text_id, name, start, score, accepted, source, country): rivers by capitalised names before the word River and by known names, each where it is named first; texts: text_id, text, core (what the study says of itself)."""
    kinds = []
    for pattern, whole in ((_NAMED, False), (_KNOWN, True)):
        cut = F.split("text", pattern)
        hits = F.regexp_extract_all("text", F.lit(pattern if not whole else f"({pattern})"), F.lit(1))
        full = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
        at = F.transform(F.sequence(F.lit(0), F.size("full") - 1), lambda i: F.struct(F.element_at("hits", i + 1).alias("raw"), (F.length(F.array_join(F.slice("cut", F.lit(1), i + 1), "")) + F.length(F.array_join(F.slice("full", F.lit(1), i), ""))).alias("start"), F.length(F.element_at("full", i + 1)).alias("size")))
        rows = texts.filter("text is not null").withColumn("full", full).filter("size(full) > 0").withColumn("hits", hits).withColumn("cut", cut)
        kinds.append(rows.select("text_id", "text", "core", F.explode(at).alias("h")).select("text_id", "text", "core", "h.*"))
    rows = kinds[0].unionByName(kinds[1])
    name = F.trim(F.regexp_replace(F.regexp_replace("raw", r"(?i)^(the|a|an)\s+", ""), r"\s+", " "))
    rows = rows.withColumn("name", F.when(F.lower(name) == "cagayan", "Cagayan River").otherwise(name)).filter("length(name) >= 3")
    low = F.greatest(F.col("start") - AROUND, F.lit(0))
    rows = rows.withColumn("around", F.lower(F.substring(F.col("text"), low + 1, F.col("start") + F.col("size") + AROUND - low)))
    first = rows.groupBy("text_id", "name").agg(F.min(F.struct("start", "size", "around", "core")).alias("b")).select("text_id", "name", "b.*")
    cited, studied = _any_of(F.col("around"), CITED), _any_of(F.col("around"), STUDIED)
    core = F.coalesce(F.lower("core").contains(F.lower("name")), F.lit(False))
    score = F.when(cited, 0.0).when(studied, 0.9).when(core, 0.5).otherwise(0.0)
    lies = F.create_map(*[F.lit(x) for pair in RIVERS.items() for x in pair])
    scored = first.withColumn("score", score).withColumn("accepted", F.col("score") > 0.4)
    source = F.when(cited, "citation").when(studied, "study_area").otherwise("unknown")
    return scored.select("text_id", "name", "start", "score", "accepted", source.alias("source"), F.when(F.col("accepted"), F.try_element_at(lies, F.col("name"))).alias("country"))


def coordinates(texts: DataFrame) -> DataFrame:
    """(text_id, form, lat, lon) of the first pair of coordinates in degrees and minutes and of the first in decimals; those beyond 90 and 180 degrees are left out."""
    part = lambda pattern, k: F.regexp_extract("text", pattern, k)
    number = lambda c: c.try_cast("double")
    degrees = texts.select("text_id", F.lit("degrees").alias("form"), (number(part(_DEGREES, 1)) + number(part(_DEGREES, 2)) / 60).alias("lat"), (number(part(_DEGREES, 3)) + number(part(_DEGREES, 4)) / 60).alias("lon"))
    signed = lambda k, minus: number(part(_DECIMAL, k)) * F.when(part(_DECIMAL, k + 1) == minus, -1).otherwise(1)
    decimal = texts.select("text_id", F.lit("decimal").alias("form"), signed(1, "S").alias("lat"), signed(3, "W").alias("lon"))
    return degrees.unionByName(decimal).filter("abs(lat) <= 90 and abs(lon) <= 180")


def geography(texts: DataFrame) -> DataFrame:
    """One row for each text: text_id, primary_country, countries, regions, rivers (accepted ones), n_coordinates, scope, confidence.

    confidence: .35 for a country of the study, .15 for any country, .20 for regions, .15 for rivers, .10 for places beside these (here: rivers not accepted are none), .05 for coordinates."""
    named = places(texts)
    listed = lambda kind: F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.struct("ord", "name"))))
    per = named.groupBy("text_id").agg(F.transform(listed("country"), lambda s: s["name"]).alias("countries"), F.transform(listed("region"), lambda s: s["name"]).alias("regions"))
    river = rivers(texts)
    flows = river.filter("accepted").groupBy("text_id").agg(F.array_sort(F.collect_list("name")).alias("rivers"), F.min_by("country", F.struct("start", "name")).alias("of_river"))
    spots = coordinates(texts).groupBy("text_id").agg(F.count("*").alias("n_coordinates"))
    rows = texts.select("text_id", F.lower("text").alias("low")).join(per, "text_id", "left").join(flows, "text_id", "left").join(spots, "text_id", "left")
    none = F.array().cast("array<string>")
    for c in ("countries", "regions", "rivers"):
        rows = rows.withColumn(c, F.coalesce(c, none))
    scope = F.array_compact(F.array(*[F.when(_any_of(F.col("low"), words), name) for name, words in SCOPES.items()]))
    rows = rows.withColumn("primary_country", F.coalesce(F.get("countries", F.lit(0)), "of_river")).withColumn("n_coordinates", F.coalesce("n_coordinates", F.lit(0)))
    sure = F.when(F.col("primary_country").isNotNull(), 35).otherwise(0) + F.when(F.size("countries") > 0, 15).otherwise(0) + F.when(F.size("regions") > 0, 20).otherwise(0)
    sure = sure + F.when(F.size("rivers") > 0, 15).otherwise(0) + F.when(F.col("n_coordinates") > 0, 5).otherwise(0)
    scoped = F.when(F.size(scope) > 0, scope).otherwise(F.array(F.lit("unknown")))
    return rows.select("text_id", "primary_country", F.array_join("countries", ",").alias("countries"), F.array_join("regions", ",").alias("regions"), F.array_join("rivers", ",").alias("rivers"), "n_coordinates", F.array_join(F.coalesce(scoped, F.array(F.lit("unknown"))), ",").alias("scope"), (sure / 100).alias("confidence"))
