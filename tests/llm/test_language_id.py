"""The posterior against a plain version, each source of evidence, and accuracy on rows the tables weren't learned from."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from marlstone.llm import language_id as L
from marlstone.llm.shared import sample_by_label


def plain_posterior(model, text, fold, declared, host, rows):
    """By the formulas, one row at a time; rows: (host, declared) of all rows."""
    real = model.languages[:-1]
    n = len(real)
    by_host, by_domain, everywhere = defaultdict(Counter), defaultdict(Counter), Counter()
    domain_of = lambda h: None if h is None else ".".join(h.split(".")[-2:])
    for h, d in rows:
        if d in real:
            by_host[h][d] += 1
            by_domain[domain_of(h)][d] += 1
            everywhere[d] += 1
    total = sum(everywhere.values()) + n
    prior = {}
    for x in real:
        of_all = (everywhere[x] + 1) / total
        d, h = by_domain[domain_of(host)], by_host[host]
        of_domain = (d[x] + L.DOMAIN_WEIGHT * of_all) / (sum(d.values()) + L.DOMAIN_WEIGHT)
        prior[x] = (h[x] + L.HOST_WEIGHT * of_domain) / (sum(h.values()) + L.HOST_WEIGHT)
    data = L.prepared(text)
    logs = {}
    for k, x in enumerate(model.languages):
        said = sum(float(model.tables[fold][b, k]) for b in L.runs_of(data)) if len(data) > 2 else 0.0
        said *= L.TEMPER * min(1.0, L.MOST_RUNS / max(1, len(data) - 2))
        p = prior.get(x, 1 / n)
        if declared in real:
            p *= 1 / n if x == "und" else L.DECLARED if x == declared else (1 - L.DECLARED) / (n - 1)
        spoken = L.SUFFIX_LANGUAGE.get(host.rpartition(".")[2]) if host and "." in host else None
        if spoken in real:
            p *= 1 / n if x == "und" else L.SUFFIX if x == spoken else (1 - L.SUFFIX) / (n - 1)
        logs[x] = said + math.log(p)
    top = max(logs.values())
    weights = {x: math.exp(v - top) for x, v in logs.items()}
    best = max(model.languages, key=lambda x: weights[x]) if data else "und"
    post = weights[best] / sum(weights.values())
    return best, post, best != "und" and post >= L.SURE


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    return L.fit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def test_posterior_by_brute_force(spark, sf_dir, model, monkeypatch):
    """Documents with declared languages changed or missing and hosts with domains and suffixes, over both ways of joining."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("doc_id < 250").selectExpr(
        "doc_id", "case when doc_id % 3 = 0 then substring(text, 1, 12) else text end as text",
        "case when doc_id % 5 = 0 then null when doc_id % 7 = 0 then 'fr' when doc_id % 11 = 0 then 'xx' else lang end as lang",
        "case when doc_id % 4 = 0 then null when doc_id % 4 = 1 then 'a.example.de' when doc_id % 4 = 2 then 'b.example.de' else source end as source",
    )
    rows = docs.withColumn("fold", L.fold_of(F.col("text"))).collect()
    told = [(r.source, r.lang) for r in rows]
    ways = []
    for most in (L.MOST_HOSTS_BROADCAST, 0):
        monkeypatch.setattr(L, "MOST_HOSTS_BROADCAST", most)
        got = {r.doc_id: r for r in L.identify(docs, model).collect()}
        for r in rows:
            language, post, kept = plain_posterior(model, r.text, r.fold, r.lang, r.source, told)
            assert (got[r.doc_id].language, got[r.doc_id].kept) == (language, kept)
            assert got[r.doc_id].posterior == pytest.approx(post, abs=2e-4)
        ways.append(sorted(r.doc_id for r in L.accepted(docs, model).collect()))
        assert ways[-1] == sorted(i for i, r in got.items() if r.kept)
    assert ways[0] == ways[1]


def test_text_wins_over_a_wrong_declaration(spark, sf_dir, model):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("length(text) > 200")
    wrong = docs.withColumn("truth", F.col("lang")).withColumn("lang", F.when(F.col("lang") == "en", "de").otherwise("en"))
    got = L.identify(wrong, model, host=F.lit(None).cast("string")).join(wrong.select("doc_id", "truth"), "doc_id")
    assert got.filter("language = truth").count() >= 0.98 * got.count()


def test_declaration_suffix_and_host_tell_short_texts(spark, model):
    """Where the text says little, each source of evidence moves the posterior; together they decide."""
    rows = [(k, "tal", "de", "x.example.de") for k in range(400)] + [(1000, "tal", None, "x.example.de"), (1001, "tal", None, "y.example.de"), (1002, "tal", None, "z.org"), (1003, "tal", "de", "z.org"), (1004, "tal", None, "only.fr")]
    got = {r.doc_id: r for r in L.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), model).collect()}
    assert got[1000].language == got[1001].language == got[1003].language == "de"
    assert got[1000].posterior > got[1001].posterior  # the host's own share, and the domain's for a host seldom seen
    assert got[1003].posterior > (got[1002].posterior if got[1002].language == "de" else 0)
    assert got[1004].language != "de" or got[1004].posterior < got[1001].posterior


def test_held_out_texts_alone(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = L.fit(docs.filter("doc_id % 2 = 0"))
    held = docs.filter("doc_id % 2 = 1")
    none = L.identify(held, model, declared=F.lit(None).cast("string"), host=F.lit("h")).join(held, "doc_id")
    assert none.filter("language = lang").count() >= 0.99 * held.count()


def test_odd_rows(spark, model):
    odd = spark.createDataFrame(
        [(1, None, "en", "s"), (2, "", "en", None), (3, "xq zvk jjw qqz ppk vvx wwz kkq zzx qjx", None, "s"), (4, "Привет как дела мир", "en", "s"), (5, "12 34", "en", "s"), (6, "Re.", "en", "s"), (6, "Re.", "en", "s"), (None, "The of and in the", "zz", "s")],
        "doc_id long, text string, lang string, source string",
    )
    for name in ("_ms_text", "_ms_fold", "_ms_host", "_ms_prior", "_ms_of", "_ms_declared", "_MS_ROW", "host", "prior", "key", "kept"):
        clash = odd.withColumn(name, F.lit(1))
        got = {r.doc_id: (r.language, r.kept) for r in L.identify(clash, model).collect()}
        assert [got[k][1] for k in (1, 2, 3, 4, 5, 6, None)] == [False] * 5 + [True, True] and got[None][0] == "en"
        kept = L.accepted(clash, model)
        assert kept.columns == clash.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 6, 6]
    assert L.identify(odd.limit(0), model).count() == 0 and L.accepted(odd.limit(0)).count() == 0
    assert {r.language for r in L.identify(odd, L.fit(odd.limit(0))).collect()} == {"und"}


def test_sums_of_long_and_short_texts(spark, sf_dir, model):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    data = [L.prepared(r.text) for r in docs.limit(40).collect()] + [b"", b"ab", b"the of and " * 400_000]
    whole, runs = L.likelihoods(data, model.tables[0])
    for t, row, n in zip(data, whole, runs, strict=True):
        want = model.tables[0][L.runs_of(t)].sum(axis=0, dtype=float) if len(t) > 2 else 0
        assert np.abs(row - want).max() <= 1e-6 * max(1, len(t)) and n == len(t) - 2


def test_rare_labels_are_learned(spark):
    rows = spark.createDataFrame([(f"t{k}", "common") for k in range(3000)] + [(f"r{k}", "rare") for k in range(5)], "text string, label string")
    sample, labels = sample_by_label(rows, "label", 200, 100)
    got = Counter(r.label for r in sample.collect())
    assert labels == ["common", "rare"] and got["rare"] == 5 and 60 <= got["common"] <= 150


def test_pages(spark, sf_dir, model):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    text, declared, host = L.markup_evidence(pages)
    row = pages.select(text.alias("t"), declared.alias("d"), host.alias("h"), "url").first()
    assert "<" not in row.t and row.d in ("en", "fr", "de", "es") and row.h in row.url
    got = L.of_pages(pages, model).join(pages.select("page_id", declared.alias("declared")), "page_id")
    assert got.count() == pages.count()
    assert got.filter("language = declared").count() >= 0.97 * pages.count()
