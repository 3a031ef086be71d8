"""The bounded sample; URL rules, features and trees against plain versions; hosts held out."""

import math
from collections import Counter

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from marlstone.llm import url_filter as U
from marlstone.llm.shared import bounded_sample


def test_bounded_sample(spark):
    rows = spark.range(5000).select((F.col("id") % 1000).alias("k"))
    assert sorted(r.k for r in bounded_sample(rows, 5000).collect()) == list(range(1000))
    some = bounded_sample(rows, 100)
    assert 50 <= some.count() <= 100 and some.distinct().count() == some.count()
    assert bounded_sample(rows.limit(0), 10).count() == 0


def plain_split(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([k for k in (rest.find(c) for c in "/?#") if k >= 0], default=len(rest))
    tail = rest[cut:]
    end = min([k for k in (tail.find(c) for c in "?#") if k >= 0], default=len(tail))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), tail[:end]


def plain_rule(host, path):
    best = None
    for r in U.RULES:
        h, p = r.text.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(r.text) > len(best.text)):
            best = r
    return (best.text, best.verdict) if best else (None, None)


URLS = ["http://A.example.NET/en/x?q=1", "https://example.net/fr", "http://net", "net/", None, "", "x://y?z", "ftp://b.org/fr/#t", "http://c.org/frx", "http://example.com/de/", "https://É.example.com/de/a/b", "http://notexample.com/de/", "http://spam.example.com/q", "a://b://net/"]


def test_rules(spark):
    rows = spark.createDataFrame([(k, u, "x") for k, u in enumerate(URLS)] + [(0, URLS[0], "x")], "page_id long, url string, host string")
    got = U.judge(rows).collect()
    assert len(got) == len(URLS) + 1
    for r in got:
        host, path = plain_split(URLS[r.page_id])
        rule, verdict = plain_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")
    assert U.judge(rows.limit(0)).count() == 0


PAGES = "/root/testdata/sf0.1/pages.parquet"


def test_features(spark):
    rows = U.prepared(spark.read.parquet(PAGES).limit(50), U.RULES, "page_id", "url").collect()
    suffixes = Counter(".".join(r.host.split(".")[-2:]) for r in rows)
    for r in rows:
        n, c = len(r.url), Counter(r.url)
        assert math.isclose(r.f_entropy, -sum(v / n * math.log2(v / n) for v in c.values()), abs_tol=1e-9)
        assert r.f_digits == sum(x.isdigit() for x in r.url) / n and r.f_depth == r.path.count("/")
        assert math.isclose(r.f_suffix_rows, math.log2(1 + suffixes[".".join(r.host.split(".")[-2:])]))


def test_case_expression_is_the_fitted_model(spark):
    """The margin of each page against Spark's own prediction of the same trees."""
    rows = U.prepared(spark.read.parquet(PAGES), U.RULES, "page_id", "url")
    margin, model = U.fit(rows.filter("y is not null"))
    vectors = VectorAssembler(inputCols=list(U.FEATURES), outputCol="features").transform(rows.withColumn("margin", margin))
    own = model.transform(vectors).select("margin", "prediction", vector_to_array("rawPrediction")[1].alias("raw")).collect()
    assert len(own) == spark.read.parquet(PAGES).count()
    assert all(math.isclose(r.margin, r.raw, rel_tol=1e-9, abs_tol=1e-9) and (r.margin > 0) == (r.prediction == 1.0) for r in own)


def test_hosts_held_out(spark):
    """Hosts of cues that no label has (bets, pills) are blocked; hosts without a listed word are left alone, with hyphens or without, whatever their suffix."""
    urls = spark.read.parquet(PAGES).select("page_id", "url")
    benign = ["my-garden.example.com", "new-york-times.example.com", "www.well-being.example.com", "e-commerce.shop.io", "assets.sextant.org", "a-b-c-d.example.org"]
    unwanted = ["casino.example.com", "bets.example.com", "gambling.info", "cheap-viagra-pills.io"]
    more = spark.createDataFrame([(-k, f"https://{h}/en/{k}?page=2") for k, h in enumerate(benign + unwanted, 1)], "page_id long, url string")
    got = U.judge(urls.unionByName(more)).toPandas()
    free = got[got.rule.isna()]
    unseen = free[free.host.str.contains("free-bets|cheap-pills") & (free.page_id >= 0)]
    words = free.host.str.split(r"[.-]", regex=True).map(set)
    plain = free[words.map(lambda w: not w & set(U.LISTED))]
    assert len(unseen) and (unseen.verdict == "block").mean() > 0.9
    assert len(plain) > 500 and (plain.verdict == "block").mean() < 0.02 and set(got[got.host.isin(benign)].verdict) == {"allow"}
    assert set(got[got.host.isin(unwanted)].verdict) == {"block"}


def test_one_class_and_no_rows(spark):
    rows = spark.createDataFrame([(1, "http://a.example.org/x"), (2, None)], "page_id long, url string")
    assert {r.verdict for r in U.judge(rows).collect()} == {"allow"}
    assert {r.verdict for r in U.judge(spark.createDataFrame([(1, "http://spam.org/x")], "page_id long, url string")).collect()} == {"block"}
