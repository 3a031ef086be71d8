"""URL verdicts: host and path rules first, gradient-boosted trees on lexical features for the rest. DataFrame functions only.

The trees learn from labelled URLs. Block: those whose host has a seed word for unwanted sites, of any of several cues. Allow: those that an allow rule decides, and those that no rule decides and whose host has no
listed word of any cue. Hosts with a listed word that is no seed have no label: the trees judge them by what they learned from the seeds, over all lexical features and how many listed words the host has.
What a block rule decides is no label: such rules are about places, not about how an address looks. No feature is made of labels: suffix statistics count the rows and hosts of the suffix, over all rows.

At most FIT_ROWS labelled rows, for each class those of least hash, are used for the fit (bounded sample of a classifier). The fitted trees are turned into
CASE expressions, so that judging runs inside generated code over every row.

Defined cases: a null url, or one without "://", has empty host and path and gets the method's verdict; an empty table, or labels of one class
only, give a constant model (the class seen, else allow); repeated rows are judged alike; further columns are left out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import ascii_lower, sample_by_label, stored

FIT_ROWS = 20_000
TREES, DEPTH = 12, 3
LEAF = 0.05  # share of the weight that a leaf has at least, so that a few wrongly labelled hosts make no leaf of their own

# Words of host labels that tell an unwanted site, by cue; the first list of each are the seeds of labels, the second are judged by the model.
CUES = {
    "advertising": (("ads", "adserver", "doubleclick", "track", "tracker"), ("banner", "clicks", "popup", "popunder")),
    "gambling": (("casino",), ("bet", "bets", "betting", "gambling", "jackpot", "lottery", "poker", "slots")),
    "adult": (("porn", "adult"), ("escort", "sex", "xxx")),
    "medicines": ((), ("meds", "pharma", "pills", "viagra")),
    "malice": (("malware", "phish", "spam", "warez"), ("crack", "keygen", "phishing", "scam", "torrent")),
}
SEEDS = tuple(w for seeds, _ in CUES.values() for w in seeds)
LISTED = tuple(w for seeds, others in CUES.values() for w in (*seeds, *others))

FEATURES = ("f_length", "f_host_length", "f_depth", "f_digits", "f_entropy", "f_params", "f_labels", "f_listed", "f_suffix_rows", "f_suffix_hosts")


@dataclass(frozen=True)
class Rule:
    verdict: str
    text: str  # host and path, such as example.net/en/

    @property
    def host(self) -> str:
        return self.text.split("/", 1)[0]

    @property
    def path(self) -> str:
        return "/" + self.text.split("/", 1)[1]

    def fits(self) -> Column:
        host = F.col("host")
        return ((host == self.host) | host.endswith("." + self.host)) & F.col("path").startswith(self.path)


# The contract's rules.
RULES = (
    Rule("block", "net/"),
    Rule("allow", "example.net/en/"),
    Rule("block", "example.com/de/"),
    Rule("allow", "org/fr/"),
)


def split_url(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """Adds host (A-Z lower-cased) and path."""
    url = F.coalesce(F.col(f"`{url_col}`"), F.lit(""))
    at = F.locate("://", url)
    rest = F.when(at > 0, F.expr("substring(_ms_url, locate('://', _ms_url) + 3)")).otherwise("")
    return (
        pages.withColumn("_ms_url", url).withColumn("_ms_rest", rest)
        .withColumn("host", ascii_lower(F.regexp_extract("_ms_rest", r"^[^/?#]*", 0)))
        .withColumn("path", F.regexp_extract("_ms_rest", r"^[^/?#]*([^?#]*)", 1))
    )


def by_rules(rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else null; of equally long ones the first given wins."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.text)):
        rule, verdict = F.when(r.fits(), r.text).otherwise(rule), F.when(r.fits(), r.verdict).otherwise(verdict)
    return rule, verdict


def _count(text: Column, what: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(what), F.lit("")))


def lexical(rows: DataFrame) -> DataFrame:
    """Adds the lexical features; those of the suffix are joined later."""
    url = F.col("_ms_url")
    n = F.greatest(F.length(url), F.lit(1)).cast("double")
    entropy = F.expr(
        "aggregate(array_distinct(split(_ms_url, '')), 0D, (acc, ch) -> acc - if(ch = '', 0D,"
        " ((length(_ms_url) - length(replace(_ms_url, ch, ''))) / cast(length(_ms_url) as double))"
        " * log2((length(_ms_url) - length(replace(_ms_url, ch, ''))) / cast(length(_ms_url) as double))))"
    )
    return (
        rows.withColumn("f_length", F.length(url).cast("double"))
        .withColumn("f_host_length", F.length("host").cast("double"))
        .withColumn("f_depth", _count(F.col("path"), "/").cast("double"))
        .withColumn("f_digits", F.length(F.regexp_replace(url, "[^0-9]", "")) / n)
        .withColumn("f_entropy", entropy)
        .withColumn("f_params", (_count(url, "&") + F.when(F.locate("?", url) > 0, 1).otherwise(0)).cast("double"))
        .withColumn("f_labels", F.size(F.split("host", r"\.")).cast("double"))
        .withColumn("f_listed", F.size(F.filter(F.split("host", r"[.-]"), lambda word: word.isin(*LISTED))).cast("double"))
        .withColumn("_ms_suffix", F.substring_index("host", ".", -2))
    )


def _tree(node, features: list[str]) -> Column:
    """A fitted tree as a CASE expression."""
    if node.subtreeDepth() == 0:
        return F.lit(float(node.prediction()))
    split = node.split()
    test = F.col(features[split.featureIndex()]) <= F.lit(float(split.threshold()))
    return F.when(test, _tree(node.leftChild(), features)).otherwise(_tree(node.rightChild(), features))


def with_suffixes(rows: DataFrame) -> DataFrame:
    """Adds the suffix statistics: logarithms of the rows and, about, of the hosts of the suffix. They are a table of their own, so that both sides of a join are
    dealt out anew and Spark can split a hot suffix; while it is small it is broadcast."""
    suffixes = stored(
        rows.groupBy(F.col("_ms_suffix").alias("_ms_of")).agg(F.log2(F.count("*") + 1.0).alias("f_suffix_rows"), F.log2(F.approx_count_distinct("host") + 1.0).alias("f_suffix_hosts")),
        "suffixes",
    )
    return rows.join(suffixes, F.col("_ms_suffix") == F.col("_ms_of")).drop("_ms_of")


def fit(labelled: DataFrame) -> tuple[Column, object]:
    """labelled has the features and y (0.0, 1.0: block). Returns the trees' margin, above 0 for block, and the fitted model (None if constant)."""
    sample, seen = sample_by_label(labelled.select(*FEATURES, "y"), "y", FIT_ROWS, 2)
    if len(seen) < 2:
        return F.lit(1.0 if seen == [1.0] else -1.0), None
    sample = stored(sample, "fit").coalesce(1)
    blocked, rows = sample.agg(F.sum("y"), F.count("*")).first()
    even = F.when(F.col("y") == 1.0, rows / (2 * blocked)).otherwise(rows / (2 * (rows - blocked)))
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(sample.withColumn("weight", even))
    model = GBTClassifier(labelCol="y", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, minWeightFractionPerNode=LEAF, stepSize=0.2, seed=11, maxBins=64).fit(vectors)
    margin = F.lit(0.0)
    for tree, weight in zip(model.trees, model.treeWeights, strict=True):
        margin = margin + F.lit(float(weight)) * _tree(tree._java_obj.rootNode(), list(FEATURES))
    return margin, model


def prepared(pages: DataFrame, rules: tuple[Rule, ...], id_col: str, url_col: str) -> DataFrame:
    """page_id, host, path, rule, the rule's verdict, features and label (y, null if none) of each row of pages."""
    rows = split_url(pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url")))
    rule, verdict = by_rules(rules)
    seed = F.exists(F.split("host", r"[.-]"), lambda word: word.isin(*SEEDS))
    rows = lexical(rows).withColumn("rule", rule).withColumn("_ms_verdict", verdict)
    plain = (F.col("host") != "") & (F.col("f_listed") == 0) & F.coalesce(F.col("_ms_verdict") == "allow", F.lit(True))
    rows = rows.withColumn("y", F.when(seed, 1.0).when(plain, 0.0))
    return with_suffixes(rows)


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict and block_margin for each row of pages."""
    rows = prepared(pages, rules, id_col, url_col)
    margin, _ = fit(rows.filter("y is not null"))
    return rows.withColumn("block_margin", margin).select(
        "page_id", "host", "path", "rule",
        F.coalesce("_ms_verdict", F.when(F.col("block_margin") > 0, "block").otherwise("allow")).alias("verdict"),
        "block_margin",
    )
