"""TEI-XML documents as tables, by Spark's own XML reader over strings.

Defined cases: null text and text that isn't XML give no rows; missing parts are null or empty arrays; a single element where several may stand is an array of one; mixed content of a
paragraph is its text; names are matched without their namespaces; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BIBL = "struct<_id string, analytic struct<title string, author array<struct<persName struct<surname string>>>>, monogr struct<title string, imprint struct<date struct<_when string>>>, idno string>"
_FIGURE = "struct<_type string, _id string, _coords string, head string, label string, figDesc string, table struct<row array<struct<cell array<string>>>>>"
_AFFILIATION = "struct<_key string, orgName array<struct<_type string, _VALUE string>>, address struct<settlement string, postCode string, country struct<_key string, _VALUE string>>>"
_AUTHOR = f"struct<persName struct<forename array<string>, surname string>, email string, affiliation array<{_AFFILIATION}>>"
_PARTS = {
    "header": f"teiHeader struct<fileDesc struct<titleStmt struct<title string>, sourceDesc struct<biblStruct struct<analytic struct<author array<{_AUTHOR}>>, idno string>>>, profileDesc struct<abstract struct<p string>>>",
    "body": f"body struct<div array<struct<head string, p array<string>, formula array<string>>>, figure array<{_FIGURE}>>",
    "back": f"back struct<listBibl struct<biblStruct array<{_BIBL}>>>",
}


def parsed(docs: DataFrame, id_col: str = "doc_id", xml_col: str = "xml", parts: Sequence[str] = tuple(_PARTS)) -> DataFrame:
    """doc_id and the document's tree (teiHeader, text) of each document that is XML. parts: what is read of it (header, body, back); a document without any of them is left out, the others are still checked to their end.

    A text is parsed once: the tree comes out of a generator, so that neither filters nor fields of it are moved to before the parse, where each would parse the text anew."""
    text = ", ".join(_PARTS[p] for p in _PARTS if p in parts and p != "header")
    told = [*([_PARTS["header"]] if "header" in parts else []), *([f"text struct<{text}>"] if text else []), "_corrupt_record string"]
    options = {"mode": "PERMISSIVE", "ignoreNamespace": "true", "columnNameOfCorruptRecord": "_corrupt_record"}
    tree = F.from_xml(F.col(f"`{xml_col}`"), F.lit(", ".join(told)), options)
    trees = [c for c, there in (("teiHeader", "header" in parts), ("text", bool(text))) if there]
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.explode(F.array(tree)).alias("t"))
    return rows.filter("t._corrupt_record is null").filter(" or ".join(f"t.{c} is not null" for c in trees)).select("doc_id", *[f"t.{c}" for c in trees])


def headers(trees: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """doc_id, title, doi, authors (surnames), abstract, n_sections, n_figures, n_tables, n_references; and the columns of trees to keep."""
    source = "teiHeader.fileDesc.sourceDesc.biblStruct"
    tables = F.size(F.filter("text.body.figure", lambda f: f["_type"] == "table"))
    n = lambda c: F.when(F.col(c).isNull(), 0).otherwise(F.size(c))
    n_tables = F.when(F.col("text.body.figure").isNull(), 0).otherwise(tables)
    return trees.select(
        "doc_id", F.trim("teiHeader.fileDesc.titleStmt.title").alias("title"), F.lower(F.trim(f"{source}.idno")).alias("doi"),
        F.coalesce(F.transform(f"{source}.analytic.author", lambda a: a["persName"]["surname"]), F.array().cast("array<string>")).alias("authors"), F.trim("teiHeader.profileDesc.abstract.p").alias("abstract"),
        n("text.body.div").alias("n_sections"), (n("text.body.figure") - n_tables).alias("n_figures"), n_tables.alias("n_tables"), n("text.back.listBibl.biblStruct").alias("n_references"), *keep,
    )


def _source_authors(trees: DataFrame) -> DataFrame:
    return trees.select("doc_id", F.posexplode("teiHeader.fileDesc.sourceDesc.biblStruct.analytic.author").alias("ord", "a"))


def authors(trees: DataFrame) -> DataFrame:
    """doc_id, ord, forenames (with a blank between them), surname, email and the keys of the affiliations of each author, in their order; what is missing is null, authors without a surname are left out."""
    said = lambda c: F.when(F.trim(c) != "", F.trim(c))
    keys = F.coalesce(F.array_compact(F.transform("a.affiliation", lambda x: x["_key"])), F.array().cast("array<string>"))
    rows = _source_authors(trees).select("doc_id", "ord", F.array_join("a.persName.forename", " ").alias("forenames"), said("a.persName.surname").alias("surname"), said("a.email").alias("email"), F.array_distinct(keys).alias("affiliations"))
    return rows.filter("surname is not null")


def affiliations(trees: DataFrame) -> DataFrame:
    """doc_id, key, institution, department, laboratory, settlement, postcode, country, country_code, address of a document's affiliations: each key once, as it comes first; those without a key count as one.

    address: settlement, postcode and country as far as they are there; what is missing is null."""
    rows = _source_authors(trees).select("doc_id", "ord", F.posexplode("a.affiliation").alias("k", "f"))
    first = rows.groupBy("doc_id", F.col("f._key").alias("key")).agg(F.min_by("f", F.struct("ord", "k")).alias("f"))
    said = lambda c: F.when(F.trim(c) != "", F.trim(c))
    named = lambda kind: said(F.get(F.filter("f.orgName", lambda o: o["_type"] == kind), F.lit(0))["_VALUE"]).alias(kind)
    parts = {"settlement": "f.address.settlement", "postcode": "f.address.postCode", "country": "f.address.country._VALUE"}
    address = F.concat_ws(", ", *[said(F.col(c)) for c in parts.values()])
    return first.select("doc_id", "key", *map(named, ("institution", "department", "laboratory")), *[said(F.col(c)).alias(k) for k, c in parts.items()], said(F.col("f.address.country._key")).alias("country_code"), F.when(address != "", address).alias("address"))


def _section(d: Column) -> list[Column]:
    return [F.trim(d["head"]).alias("title"), F.coalesce(d["p"], F.array().cast("array<string>")).alias("paragraphs"), F.when(d["formula"].isNull(), 0).otherwise(F.size(d["formula"])).alias("n_formulas")]


def sections(trees: DataFrame) -> DataFrame:
    """doc_id, ord (from 0), title, paragraphs, n_formulas of each section of the body."""
    return trees.select("doc_id", F.posexplode("text.body.div").alias("ord", "d")).select("doc_id", "ord", *_section(F.col("d")))


def with_first_section(trees: DataFrame, name: str = "first") -> DataFrame:
    """The trees that have sections, with title, paragraphs, n_formulas of the first one as a struct."""
    return trees.filter(F.size("text.body.div") > 0).withColumn(name, F.struct(*_section(F.get("text.body.div", F.lit(0)))))


def table_cells(trees: DataFrame) -> DataFrame:
    """table_id (doc_id and the table's place, as <doc>_tbl_001), row_no and cells of all tables, as operators.tables reads them."""
    tables = trees.select("doc_id", F.posexplode(F.filter("text.body.figure", lambda f: f["_type"] == "table")).alias("k", "f"))
    named = F.format_string("%s_tbl_%03d", F.col("doc_id").cast("string"), F.col("k") + 1)
    rows = tables.select(named.alias("table_id"), F.posexplode("f.table.row").alias("row_no", "r"))
    return rows.select("table_id", "row_no", F.col("r.cell").alias("cells"))


def references(trees: DataFrame) -> DataFrame:
    """doc_id, ord, title, year, doi, n_authors and reference_id (sha1 of DOI or title) of each entry of the bibliography."""
    rows = trees.select("doc_id", F.posexplode("text.back.listBibl.biblStruct").alias("ord", "b"))
    title, doi = F.trim(F.coalesce("b.analytic.title", "b.monogr.title")), F.lower(F.trim("b.idno"))
    told = F.coalesce(F.concat(F.lit("doi:"), doi), F.concat(F.lit("title:"), F.lower(title)))
    return rows.select(
        "doc_id", "ord", title.alias("title"), F.substring("b.monogr.imprint.date._when", 1, 4).alias("year"), doi.alias("doi"), F.when(F.col("b.analytic.author").isNull(), 0).otherwise(F.size("b.analytic.author")).alias("n_authors"),
        F.substring(F.sha1(told), 1, 16).alias("reference_id"),
    )
