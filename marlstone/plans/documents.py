"""Queries on Markdown documents, aliases of entities and bibliographies. Documents are put together from orders and their lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import aliases as A
from ..operators import tables
from ..sources import markdown as M
from ..sources import tei as TEI
from .phrases import phrase, phrase_sql, quoted
from .registry import Tables, query

TITLES = ("Introduction", "Methods", "Results and discussion", "Study area", "Data")


def markdown_documents(t: Tables) -> DataFrame:
    """doc_id and text: headings of two levels, text lines, a formula of one or three lines, a pipe table, references with a repeated entry."""
    key = F.col("o_orderkey")
    k = key.cast("string")
    formula = F.when(key % 3 == 0, F.concat(F.lit("$$ NSE = "), k, F.lit(" $$"))).when(key % 3 == 1, F.concat(F.lit("$$\na = "), k, F.lit("\n$$"))).otherwise(F.lit("\\[\nb\n\\]"))
    table = F.concat(F.lit("| Site | NSE | plain |\n|---|:-:|---|\n| one | 0."), (key % 10).cast("string"), F.lit(" | 3 |\n| two | 7 | 4 |"))
    refs = F.concat(F.lit("# References\nA. Author, Title "), (key % 4).cast("string"), F.lit(". doi 10.1234/AB"), (key % 4).cast("string"), F.lit("\nB. Other, a Work\nb other; A WORK!\nA. Author again 10.1234/ab"), (key % 4).cast("string"))
    parts = F.array(
        F.when(key % 5 == 0, F.lit("loose text")), F.concat(F.lit("# "), phrase(key, TITLES, ((1, 0),))), F.lit("some text"), formula, F.concat(F.lit("## "), phrase(key, TITLES, ((3, 1),))),
        F.lit("more text\n"), F.when(key % 2 == 0, table), F.when(key % 7 == 0, F.lit("### Deeper\nlast")), refs,
    )
    return t.orders.select(key.alias("doc_id"), F.concat_ws("\n", parts).alias("text"))


_DOCS = f"""docs AS (SELECT o_orderkey AS doc_id, concat_ws(chr(10), CASE WHEN o_orderkey % 5 = 0 THEN 'loose text' END, '# ' || {phrase_sql('o_orderkey', TITLES, ((1, 0),))}, 'some text',
    CASE o_orderkey % 3 WHEN 0 THEN '$$ NSE = ' || o_orderkey || ' $$' WHEN 1 THEN '$$' || chr(10) || 'a = ' || o_orderkey || chr(10) || '$$' ELSE '\\[' || chr(10) || 'b' || chr(10) || '\\]' END, '## ' || {phrase_sql('o_orderkey', TITLES, ((3, 1),))}, 'more text' || chr(10),
    CASE WHEN o_orderkey % 2 = 0 THEN '| Site | NSE | plain |' || chr(10) || '|---|:-:|---|' || chr(10) || '| one | 0.' || (o_orderkey % 10) || ' | 3 |' || chr(10) || '| two | 7 | 4 |' END, CASE WHEN o_orderkey % 7 = 0 THEN '### Deeper' || chr(10) || 'last' END,
    '# References' || chr(10) || 'A. Author, Title ' || (o_orderkey % 4) || '. doi 10.1234/AB' || (o_orderkey % 4) || chr(10) || 'B. Other, a Work' || chr(10) || 'b other; A WORK!' || chr(10) || 'A. Author again 10.1234/ab' || (o_orderkey % 4)) AS text FROM orders),
    raw AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM docs),
    marked AS (SELECT *, regexp_matches(line, '^#{{1,6}}\\s+') AS head, CASE WHEN regexp_matches(line, '^#{{1,6}}\\s+') THEN length(regexp_extract(line, '^#+')) END AS level, regexp_replace(line, '^#+\\s+', '') AS title, (length(line) - length(replace(line, '$$', ''))) / 2 % 2 + (line LIKE '\\[%')::INT + (line LIKE '%\\]')::INT AS m FROM raw),
    placed AS (SELECT *, sum(head::INT) OVER w AS ord, sum(m) OVER w AS upto FROM marked WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
    told AS (SELECT *, CASE WHEN (upto - m) % 2 = 1 OR m = 1 OR contains(line, '$$') THEN 'math' WHEN head THEN 'heading' WHEN line LIKE '|%|' THEN 'table' WHEN trim(line) = '' THEN 'blank' ELSE 'text' END AS kind FROM placed)"""


@query(
    "S9 E3 E38",
    f"""WITH {_DOCS}, s AS (SELECT doc_id, ord, max(level) AS level, max(title) FILTER (WHERE kind = 'heading') AS title, count(*) FILTER (WHERE kind = 'text') AS n_lines, count(*) FILTER (WHERE kind = 'math' AND (upto - m) % 2 = 0) AS n_formulas, (count(*) FILTER (WHERE kind = 'table') > 0)::BIGINT AS n_tables FROM told GROUP BY 1, 2)
        SELECT doc_id, ord::BIGINT AS ord, level::INT AS level, title, n_lines, n_formulas, n_tables, (SELECT max(p.ord) FROM s p WHERE p.doc_id = s.doc_id AND p.ord < s.ord AND p.level < s.level)::BIGINT AS parent FROM s WHERE ord > 0 OR n_lines + n_formulas + n_tables > 0""",
)
def s_markdown_sections(t: Tables) -> DataFrame:
    """Sections of Markdown documents with the section they lie in and what they hold."""
    return M.sections(M.lines(markdown_documents(t)))


@query("S9 E6", f"WITH {_DOCS} SELECT doc_id || ':' || 'NSE' AS fact, try_cast(trim(split_part(line, '|', 3)) AS DOUBLE) AS value FROM told WHERE kind = 'table' AND line NOT LIKE '|---%' AND try_cast(trim(split_part(line, '|', 3)) AS DOUBLE) BETWEEN -10 AND 1")
def s_markdown_tables(t: Tables) -> DataFrame:
    """Pipe tables of documents read as tables of facts."""
    facts = tables.numeric_facts(M.table_cells(M.lines(markdown_documents(t))))
    return facts.select(F.concat_ws(":", F.split_part("table_id", F.lit(":"), F.lit(1)), F.lit("NSE")).alias("fact"), "value")


@query(
    "E22 U6",
    f"""WITH {_DOCS}, r AS (SELECT *, last_value(title IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY i) AS within FROM (SELECT doc_id, i, line, kind, CASE WHEN head THEN title END AS title FROM told)),
        k AS (SELECT doc_id, i, line AS ref, CASE WHEN regexp_matches(line, '10\\.\\d{{4,9}}/') THEN 'doi:' || lower(regexp_extract(line, '10\\.\\d{{4,9}}/[^\\s,;]+')) ELSE 'title:' || regexp_replace(lower(line), '[^a-z0-9]+', '', 'g') END AS key FROM r WHERE kind = 'text' AND within = 'References')
        SELECT doc_id, key, arg_min(ref, i) AS ref, count(*) AS n FROM k GROUP BY 1, 2""",
)
def e_bibliography(t: Tables) -> DataFrame:
    """Entries of the references, once for each DOI or title."""
    return M.references(M.lines(markdown_documents(t)))


# --- TEI -----------------------------------------------------------------------------------------------------------------


def tei_documents(t: Tables) -> DataFrame:
    """doc_id and xml: a header with one or two authors, two sections, a figure and a table, two references; every eleventh isn't XML."""
    k = F.col("o_orderkey").cast("string")
    key = F.col("o_orderkey")
    author = lambda n: f"<author><persName><surname>{n}</surname></persName></author>"
    xml = F.concat(
        F.lit('<TEI xmlns="http://www.tei-c.org/ns/1.0"><teiHeader><fileDesc><titleStmt><title> Title '), k, F.lit("</title></titleStmt><sourceDesc><biblStruct><analytic>" + author("Ash")), F.when(key % 2 == 0, author("Birch")).otherwise(""),
        F.lit("</analytic><idno>10.5/X"), k, F.lit("</idno></biblStruct></sourceDesc></fileDesc><profileDesc><abstract><p>About it</p></abstract></profileDesc></teiHeader><text><body><div><head>"), phrase(key, TITLES, ((1, 0),)),
        F.lit("</head><p>One.</p><p>Two.</p><formula>a=b</formula></div><div><head>End</head></div>"), F.when(key % 3 == 0, '<figure><head>Map</head></figure>').otherwise(""),
        F.lit('<figure type="table"><head>Scores</head><table><row><cell>Site</cell><cell>KGE</cell><cell>n</cell></row><row><cell>a</cell><cell>0.'), (key % 10).cast("string"), F.lit("</cell><cell>12</cell></row><row><cell>b</cell><cell>3</cell><cell>8</cell></row></table></figure></body><back><listBibl>"),
        F.lit("<biblStruct><analytic><title>Old work</title>" + author("Elm") + author("Fir") + '</analytic><monogr><imprint><date when="1999-05"/></imprint></monogr><idno>10.7/Y'), (key % 5).cast("string"), F.lit("</idno></biblStruct><biblStruct><monogr><title>A Book</title></monogr></biblStruct>"),
        F.when(key % 11 == 0, "</listBibl>").otherwise("</listBibl></back></text></TEI>"),
    )
    return _dealt_out(t.orders.select("o_orderkey"), "o_orderkey").select(key.alias("doc_id"), xml.alias("xml"))


def _dealt_out(keys: DataFrame, key: str) -> DataFrame:
    """The keys dealt out to all shuffle partitions before documents are made from them: a small file of keys would else be one task's documents, and adaptive execution would put them together again by their size."""
    return keys.repartition(int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


@query(
    "S8",
    f"""SELECT o_orderkey AS doc_id, 'Title ' || o_orderkey AS title, '10.5/x' || o_orderkey AS doi, CASE WHEN o_orderkey % 2 = 0 THEN 'Ash,Birch' ELSE 'Ash' END AS authors, 'About it' AS abstract, 2 AS n_sections, (o_orderkey % 3 = 0)::INT AS n_figures, 1 AS n_tables, 2 AS n_references,
        {phrase_sql('o_orderkey', TITLES, ((1, 0),))} AS first_section, 2 AS n_paragraphs, 1 AS n_formulas FROM orders WHERE o_orderkey % 11 <> 0""",
)
def s_tei_documents(t: Tables) -> DataFrame:
    """Headers of TEI documents with their first sections."""
    rows = TEI.headers(TEI.with_first_section(TEI.parsed(tei_documents(t))), ["first"]).withColumn("authors", F.array_join("authors", ","))
    return rows.select("*", F.col("first.title").alias("first_section"), F.size("first.paragraphs").alias("n_paragraphs"), "first.n_formulas").drop("first")


@query("S8 E4", "SELECT o_orderkey || '_tbl_001' AS table_id, 1 AS row_no, 'metric.kge' AS metric, ('0.' || (o_orderkey % 10))::DOUBLE AS value FROM orders WHERE o_orderkey % 11 <> 0")
def s_tei_facts(t: Tables) -> DataFrame:
    """Facts from the tables of TEI documents."""
    return tables.numeric_facts(TEI.table_cells(TEI.parsed(tei_documents(t), parts=["body"]))).select("table_id", "row_no", "metric", "value")


@query(
    "S8 E38",
    """WITH r AS (SELECT o_orderkey AS doc_id, unnest([0, 1]) AS ord FROM orders WHERE o_orderkey % 11 <> 0) SELECT doc_id, ord, CASE ord WHEN 0 THEN 'Old work' ELSE 'A Book' END AS title, CASE ord WHEN 0 THEN '1999' END AS year, CASE ord WHEN 0 THEN '10.7/y' || (doc_id % 5) END AS doi,
       CASE ord WHEN 0 THEN 2 ELSE 0 END AS n_authors, substr(sha1(CASE ord WHEN 0 THEN 'doi:10.7/y' || (doc_id % 5) ELSE 'title:a book' END), 1, 16) AS reference_id FROM r""",
)
def s_tei_references(t: Tables) -> DataFrame:
    """Bibliographies of TEI documents."""
    return TEI.references(TEI.parsed(tei_documents(t), parts=["back"]))


def tei_people(t: Tables) -> DataFrame:
    """doc_id and xml: one author for each line of an order, with one or two affiliations told in full at their first author only."""
    def author(line: Column) -> Column:
        n, supplier = line["l_linenumber"], (line["l_suppkey"] % 4).cast("string")
        full = F.concat(
            F.lit('<orgName type="institution">Institute '), supplier, F.lit("</orgName>"), F.when(n % 2 == 0, '<orgName type="department"> Waters </orgName>').otherwise(""), F.lit("<address>"), F.when(n % 3 == 0, "<settlement>Brno</settlement>").otherwise(""),
            F.when(n % 5 == 0, "<postCode>602</postCode>").otherwise(""), F.lit('<country key="CZ">Czechia</country></address>'),
        )
        return F.concat(
            F.lit("<author><persName><forename>A</forename>"), F.when(n % 2 == 0, "<forename>B</forename>").otherwise(""), F.when(n % 4 > 0, F.concat(F.lit("<surname>Name"), n.cast("string"), F.lit("</surname>"))).otherwise(""), F.lit("</persName>"),
            F.when(n == 1, "<email>a@b.org</email>").otherwise(""), F.lit('<affiliation key="aff'), supplier, F.lit('">'), full, F.lit("</affiliation>"), F.when(n % 3 == 1, '<affiliation key="aff9"><orgName type="laboratory">Lab</orgName></affiliation>').otherwise(""), F.lit("</author>"),
        )

    # lines are dealt out and put in order; authors are made of them after that, so that no texts are moved
    lines = _dealt_out(t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey"), "l_orderkey").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_suppkey"))).alias("lines"))
    body = lines.select("l_orderkey", F.array_join(F.transform("lines", author), "").alias("a"))
    head, tail = '<TEI xmlns="http://www.tei-c.org/ns/1.0"><teiHeader><fileDesc><titleStmt><title>T</title></titleStmt><sourceDesc><biblStruct><analytic>', "</analytic></biblStruct></sourceDesc></fileDesc></teiHeader></TEI>"
    return body.select(F.col("l_orderkey").alias("doc_id"), F.concat(F.lit(head), "a", F.lit(tail)).alias("xml"))


_PEOPLE = "p AS (SELECT l_orderkey AS doc_id, l_linenumber AS n, l_suppkey % 4 AS s, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey) - 1 AS ord FROM lineitem)"


@query(
    "S8",
    f"""WITH {_PEOPLE}, f AS (SELECT doc_id, 'aff' || s AS key, ord, 0 AS k, n, s FROM p UNION ALL SELECT doc_id, 'aff9', ord, 1, NULL, NULL FROM p WHERE n % 3 = 1), m AS (SELECT doc_id, key, arg_min(row(n, s), row(ord, k)) AS r FROM f GROUP BY 1, 2), x AS (SELECT doc_id, key, r[1] AS n, r[2] AS s FROM m)
        SELECT doc_id, key, 'Institute ' || s AS institution, CASE WHEN n % 2 = 0 THEN 'Waters' END AS department, CASE WHEN key = 'aff9' THEN 'Lab' END AS laboratory, CASE WHEN n % 3 = 0 THEN 'Brno' END AS settlement, CASE WHEN n % 5 = 0 THEN '602' END AS postcode, CASE WHEN key <> 'aff9' THEN 'Czechia' END AS country,
            CASE WHEN key <> 'aff9' THEN 'CZ' END AS country_code, nullif(concat_ws(', ', CASE WHEN n % 3 = 0 THEN 'Brno' END, CASE WHEN n % 5 = 0 THEN '602' END, CASE WHEN key <> 'aff9' THEN 'Czechia' END), '') AS address FROM x""",
)
def s_tei_affiliations(t: Tables) -> DataFrame:
    """Affiliations of TEI documents, each key once."""
    return TEI.affiliations(TEI.parsed(tei_people(t), parts=["header"]))


@query(
    "S8",
    f"""WITH {_PEOPLE} SELECT doc_id, ord::INT AS ord, CASE WHEN n % 2 = 0 THEN 'A B' ELSE 'A' END AS forenames, 'Name' || n AS surname, CASE WHEN n = 1 THEN 'a@b.org' END AS email, CASE WHEN n % 3 = 1 THEN 'aff' || s || ',aff9' ELSE 'aff' || s END AS affiliations FROM p WHERE n % 4 > 0""",
)
def s_tei_authors(t: Tables) -> DataFrame:
    """Authors of TEI documents with the keys of their affiliations."""
    return TEI.authors(TEI.parsed(tei_people(t), parts=["header"])).withColumn("affiliations", F.array_join("affiliations", ","))


@query(
    "S9 X8",
    r"""WITH d AS (SELECT doc_id, unnest(string_split(replace(text, '$', ''), chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents WHERE text IS NOT NULL), l AS (SELECT doc_id, i, line, i % 5 = 2 AS head FROM d), o AS (SELECT *, sum(head::INT) OVER w AS ord, sum((head OR trim(line) = '' OR i % 7 = 6)::INT) OVER w AS part FROM l WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
        b AS (SELECT doc_id, ord, part, string_agg(trim(line), ' ' ORDER BY i) AS text FROM o WHERE NOT head AND trim(line) <> '' GROUP BY 1, 2, 3), n AS (SELECT *, row_number() OVER (PARTITION BY doc_id, ord ORDER BY part) - 1 AS paragraph FROM b),
        s AS (SELECT doc_id, ord, paragraph, list_filter(string_split(regexp_replace(text, '([.!?])\s+(\p{Lu})', '\1' || chr(1) || '\2', 'g'), chr(1)), lambda s_: regexp_matches(s_, '[\p{L}\p{N}]')) AS s FROM n)
        SELECT doc_id, ord::BIGINT AS ord, paragraph::INT AS paragraph, (unnest(range(1, len(s) + 1)) - 1)::INT AS place, trim(unnest(s)) AS sentence FROM s""",
)
def s_markdown_sentences(t: Tables) -> DataFrame:
    """Sentences of all documents as Markdown: of the lines of a text every fifth is a heading, before every seventh stands an empty line; signs of formulas are taken out."""
    line = F.transform(F.split(F.replace("text", F.lit("$"), F.lit("")), "\n"), lambda x, i: F.when((i + 1) % 5 == 2, F.concat(F.lit("# "), x)).when((i + 1) % 7 == 6, F.concat(F.lit("\n"), x)).otherwise(x))
    docs = t.documents.filter("text is not null").select("doc_id", F.array_join(line, "\n").alias("text"))
    return M.sentences(M.lines(docs))


# --- aliases ------------------------------------------------------------------------------------------------------------

KINDS = ("method", "metric", "sensor")
LEADS = ("the", "new", "", "improved")
TAILS = ("", "model", "data", "model data", "sar imagery", "curve", "based network", "of it")


def entities(t: Tables) -> DataFrame:
    """Entities by the names of parts, several of them with one alias."""
    key = F.col("p_partkey")
    name = F.concat_ws(" ", "p_name", (key % 50).cast("string"))
    kind = phrase(key, KINDS, ((1, 0),))
    return t.part.select(F.concat_ws(".", kind, F.concat(F.lit("e"), key.cast("string"))).alias("entity_id"), key.alias("ord"), name.alias("name"), F.array(F.concat(F.col("p_name"), F.lit(" "), F.col("p_brand"))).alias("aliases"))


def mentions(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    named = t.part.select(F.col("p_partkey").alias("k"), "p_name", "p_brand")
    rows = t.orders.select(key.alias("mention_id"), F.pmod(key * 7 + 3, F.lit(400)).alias("k"))
    core = F.when(F.col("mention_id") % 3 == 0, F.concat_ws(" ", "p_name", "p_brand")).when(F.col("mention_id") % 3 == 1, F.concat_ws("-", "p_name", (F.col("k") % 50).cast("string"))).otherwise(F.concat(F.lit("E"), F.col("k").cast("string")))
    text = F.concat_ws(" ", phrase(F.col("mention_id"), LEADS, ((5, 1),)), core, phrase(F.col("mention_id"), TAILS, ((3, 2),)))
    return rows.join(F.broadcast(named), "k").select("mention_id", text.alias("mention"), phrase(F.col("mention_id"), KINDS, ((11, 0),)).alias("kind"))


_SLUG = "trim(regexp_replace(lower({}), '[^a-z0-9]+', '_', 'g'), '_')"
_ENTITIES = f"""e AS (SELECT {phrase_sql('p_partkey', KINDS, ((1, 0),))} || '.e' || p_partkey AS entity_id, p_partkey AS ord, p_name || ' ' || (p_partkey % 50) AS name, p_name || ' ' || p_brand AS alias FROM part),
    said AS (SELECT entity_id, ord, unnest([entity_id, split_part(entity_id, '.', 2), name, alias]) AS s FROM e), aliases AS (SELECT {_SLUG.format('s')} AS alias, arg_max(entity_id, ord) AS entity_id FROM said GROUP BY 1),
    m AS (SELECT o_orderkey AS mention_id, concat_ws(' ', {phrase_sql('o_orderkey', LEADS, ((5, 1),))}, CASE o_orderkey % 3 WHEN 0 THEN p_name || ' ' || p_brand WHEN 1 THEN p_name || '-' || (p_partkey % 50) ELSE 'E' || p_partkey END, {phrase_sql('o_orderkey', TAILS, ((3, 2),))}) AS mention, {phrase_sql('o_orderkey', KINDS, ((11, 0),))} AS kind
          FROM orders JOIN part ON p_partkey = (o_orderkey * 7 + 3) % 400), w AS (SELECT mention_id, kind, string_split({_SLUG.format('mention')}, '_') AS w FROM m),
    spans AS (SELECT mention_id, kind, w, i, j FROM w, range(1, 12) a(i), range(1, 12) b(j) WHERE i <= j AND j <= len(w)),
    c AS (SELECT mention_id, kind, CASE WHEN i = 1 AND j = len(w) THEN 1 WHEN i = 1 AND len(list_filter(w[j + 1:], lambda x: list_contains([{', '.join(map(quoted, A.NOISE))}], x))) = len(w) - j THEN 2 ELSE 3 END AS step, i, j, len(w) AS n, array_to_string(w[i:j], '_') AS alias FROM spans),
    x AS (SELECT *, CASE step WHEN 1 THEN 0 WHEN 2 THEN n - j ELSE (n - (j - i + 1)) * 1000 + i END AS rank FROM c WHERE step < 3 OR j > i)"""


@query("O1 O3", f"WITH {_ENTITIES}, h AS (SELECT mention_id, step, rank, entity_id FROM x JOIN aliases USING (alias)), b AS (SELECT mention_id, first(entity_id ORDER BY step, rank) AS entity_id, min(step) AS step FROM h GROUP BY 1) SELECT mention_id, entity_id, CASE step WHEN 1 THEN 'exact' WHEN 2 THEN 'truncated' WHEN 3 THEN 'phrase' ELSE 'unknown' END AS how FROM m LEFT JOIN b USING (mention_id)")
def o_alias_cascade(t: Tables) -> DataFrame:
    """Mentions found as they are, without noise words at their end, or by their longest part."""
    return A.resolved(mentions(t), A.alias_table(entities(t)))


@query("O4 O12", f"WITH {_ENTITIES}, h AS (SELECT mention_id, step, rank, entity_id FROM x JOIN aliases USING (alias) WHERE split_part(entity_id, '.', 1) = kind OR (kind = 'method' AND split_part(entity_id, '.', 1) = 'sensor')), b AS (SELECT mention_id, first(entity_id ORDER BY step, rank) AS entity_id, min(step) AS step FROM h GROUP BY 1) SELECT mention_id, entity_id, CASE step WHEN 1 THEN 'exact' WHEN 2 THEN 'truncated' WHEN 3 THEN 'phrase' ELSE 'unknown' END AS how FROM m LEFT JOIN b USING (mention_id)")
def o_alias_types(t: Tables) -> DataFrame:
    """The same, for entities of the mention's kind only, or of one that goes with it."""
    kind = F.split_part("entity_id", F.lit("."), F.lit(1))
    fits = (kind == F.col("kind")) | ((F.col("kind") == "method") & (kind == "sensor"))
    return A.resolved(mentions(t), A.alias_table(entities(t)), fits)


@query(
    "O5",
    f"""WITH {_ENTITIES}, h AS (SELECT mention_id AS text_id, entity_id, max(length(alias)) AS n FROM c JOIN aliases USING (alias) WHERE j - i < 6 GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY text_id ORDER BY n DESC, entity_id) AS rank FROM h) SELECT text_id, rank::INT AS rank, entity_id FROM r WHERE rank <= 5""",
)
def o_candidates(t: Tables) -> DataFrame:
    """The five entities with the longest alias in a text."""
    return A.contained(mentions(t).select(F.col("mention_id").alias("text_id"), F.col("mention").alias("text")), A.alias_table(entities(t)))
