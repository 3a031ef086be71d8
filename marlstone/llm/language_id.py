"""Language by Bayesian fusion of evidence: text, declared language, address suffix and host.

* Text: each language, and an "und" background, has a table of smoothed log-likelihoods of three-byte runs of lower-cased text, learned from
  at most FIT_ROWS labelled documents (for each label those of least hash, about an even share; labels are the MOST_LANGUAGES commonest of all rows). Rows fall into FOLDS folds by
  their text, and a row is judged by a table learned from the other folds, so no text speaks for its own label. Runs overlap and hang together, so their sum
  counts TEMPER-fold, and at most as MOST_RUNS runs, so that long texts don't drown all other evidence.
* Declared language (a column, or the lang attribute of markup): right with probability DECLARED, else any other.
* Address suffix: a country suffix of a language speaks for it with probability SUFFIX.
* Host: the share of languages declared on it, smoothed towards its domain's share, which is smoothed towards that of all rows; grouped
  aggregates over all rows.

The posterior is their normalised product. A row is rejected if the background wins, or no language reaches SURE.

While hosts are few their priors are broadcast and rows judged where they are. Beyond MOST_HOSTS_BROADCAST hosts, only likelihoods, the
declared language and the host are dealt out to meet the priors, never texts, and `accepted` takes the rejected rows out by their key.

Defined cases: a text without letters (null and empty ones too) is rejected, whatever was declared; one of less than three bytes of letters is judged by the other evidence; null hosts are one host; unknown declared
values count as none declared; ties go to the language first in order; repeated rows are judged alike; an empty table gives no rows, and
without labelled rows every text is "und"; further columns, whatever their names, are kept by `accepted` and left out of `identify`.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bloom
from .shared import arrow_map, fresh, sample_by_label, stored

FIT_ROWS, MOST_LANGUAGES, FOLDS = 4000, 100, 2
BUCKETS = 1 << 16
SMOOTH = 0.5
TEMPER, MOST_RUNS = 0.2, 2000
DECLARED, SUFFIX = 0.9, 0.7
SURE = 0.5
HOST_WEIGHT, DOMAIN_WEIGHT = 50.0, 500.0
MOST_HOSTS_BROADCAST = 100_000
CHUNK = 1 << 21

# Country suffixes and the language they speak for.
SUFFIX_LANGUAGE = {"ar": "es", "at": "de", "au": "en", "ca": "en", "cl": "es", "co": "es", "de": "de", "es": "es", "fr": "fr", "ie": "en", "it": "it", "jp": "ja", "mx": "es", "nl": "nl", "nz": "en", "pl": "pl", "pt": "pt", "ru": "ru", "uk": "en", "us": "en"}


@dataclass
class Model:
    languages: list[str]  # the background "und" comes last
    tables: np.ndarray  # [fold, bucket, language], log-likelihoods for judging rows of the fold


def runs_of(data: bytes) -> np.ndarray:
    """Buckets of the three-byte runs of a buffer, one for each place but the last two."""
    b = np.frombuffer(data, np.uint8).astype(np.uint32)
    return ((b[:-2] * np.uint32(40503) + b[1:-1] * np.uint32(9176) * np.uint32(7) + b[2:] * np.uint32(2654435)) >> np.uint32(5)) % np.uint32(BUCKETS)


def prepared(text: str | None) -> bytes:
    """Lower-cased text; white space, digits and ASCII signs say nothing of the language and are one space."""
    return b" ".join((text or "").lower().encode().translate(LETTERS).split())


LETTERS = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def fold_of(text: Column) -> Column:
    return F.pmod(F.xxhash64(F.coalesce(text, F.lit(""))), F.lit(FOLDS)).cast("int")


def fit(docs: DataFrame, text_col: str = "text", label_col: str = "lang", fit_rows: int = FIT_ROWS) -> Model:
    """Counts of runs by language and fold in a bounded sample of labelled rows."""
    rows = docs.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{label_col}`").alias("label")).filter("text is not null and label is not null")
    sample, languages = sample_by_label(rows, "label", fit_rows, MOST_LANGUAGES)

    def make() -> Callable:
        def one(batch):
            held: dict[tuple[str, int], list[np.ndarray]] = {}
            for text, label, fold in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                data = prepared(text)
                if len(data) > 2:
                    held.setdefault((label, fold), []).append(runs_of(data).astype(np.int32))
            labels, folds, runs, counts = [], [], [], []
            for (label, fold), parts in held.items():
                k, n = np.unique(np.concatenate(parts), return_counts=True)
                labels += [label] * len(k)
                folds += [fold] * len(k)
                runs.append(k)
                counts.append(n)
            if not labels:
                return None
            cols = [pa.array(labels, pa.string()), pa.array(folds, pa.int32()), pa.array(np.concatenate(runs), pa.int32()), pa.array(np.concatenate(counts), pa.int64())]
            return pa.RecordBatch.from_arrays(cols, names=["label", "fold", "k", "n"])

        return one

    found = arrow_map(sample.withColumn("fold", fold_of(F.col("text"))), make, "label string, fold int, k int, n long")
    tables = np.full((FOLDS, BUCKETS, len(languages) + 1), SMOOTH)
    for r in found.groupBy("label", "fold", "k").agg(F.sum("n").alias("n")).collect():
        for fold in range(FOLDS):
            if fold != r.fold:
                tables[fold, r.k, languages.index(r.label)] += r.n
    tables = np.log(tables / tables.sum(axis=1, keepdims=True))  # the background is even over all runs
    return Model([*languages, "und"], tables.astype(np.float32))


def likelihoods(texts: list[bytes], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of log-likelihoods [text, language] and the number of runs of each text: -2 if it has no letters."""
    out, runs = np.zeros((len(texts), table.shape[1])), np.array([len(t) - 2 for t in texts], np.int64)
    held: list[int] = []
    size = 0

    def flush():
        lengths = np.array([len(texts[k]) for k in held])
        data = b"".join(texts[k] for k in held)
        ends = np.cumsum(lengths)
        score = table[runs_of(data)]
        for j in range(1, len(held)):  # runs across texts count for none
            score[ends[j - 1] - 2 : ends[j - 1]] = 0
        out[held] = np.add.reduceat(score, ends - lengths, axis=0, dtype=np.float64)

    for k, t in enumerate(texts):
        if len(t) > CHUNK:  # a long text by itself, in parts that overlap by two bytes
            for a in range(0, len(t) - 2, CHUNK):
                out[k] += table[runs_of(t[a : a + CHUNK + 2])].sum(axis=0, dtype=np.float64)
        elif len(t) > 2:
            held.append(k)
            size += len(t)
            if size > CHUNK:
                flush()
                held, size = [], 0
    if held:
        flush()
    return out, runs


def folded(texts: list[bytes], folds: list[int], tables: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """likelihoods, each text by its fold's table."""
    out, runs, folds = np.zeros((len(texts), tables.shape[2])), np.zeros(len(texts), np.int64), np.array(folds)
    for f in range(len(tables)):
        own = np.flatnonzero(folds == f)
        out[own], runs[own] = likelihoods([texts[k] for k in own], tables[f])
    return out, runs


def host_priors(rows: DataFrame, languages: list[str]) -> DataFrame:
    """of (host) and prior (shares in the order of languages), from rows of host and declared; smoothed from host to domain to all rows."""
    real = languages[:-1]
    counts = rows.groupBy("host").agg(*[F.sum((F.col("declared").eqNullSafe(x)).cast("double")).alias(f"n{k}") for k, x in enumerate(real)], F.count("*").alias("rows"))
    counts = stored(counts.withColumn("domain", F.substring_index("host", ".", -2)), "hosts")
    sums = [F.sum(f"n{k}").alias(f"n{k}") for k in range(len(real))]
    row = counts.agg(*sums).first() if real else []
    everywhere = [(x or 0.0) + 1.0 for x in row]
    everywhere = [x / sum(everywhere) for x in everywhere]
    by_domain = counts.groupBy("domain").agg(F.count("*").alias("hosts"), *[F.sum(f"n{k}").alias(f"d{k}") for k in range(len(real))])
    both = counts.join(stored(by_domain.withColumnRenamed("domain", "within"), "domains"), F.col("domain").eqNullSafe(F.col("within")))

    def total(letter: str) -> Column:
        return sum((F.col(f"{letter}{k}") for k in range(len(real))), F.lit(0.0))

    shares = []
    for k, share in enumerate(everywhere):
        domain = (F.col(f"d{k}") + DOMAIN_WEIGHT * share) / (total("d") + DOMAIN_WEIGHT)
        shares.append((F.col(f"n{k}") + HOST_WEIGHT * domain) / (total("n") + HOST_WEIGHT))
    return stored(both.select(F.col("host").alias("of"), F.array(*shares).cast("array<double>").alias("prior")), "priors")


def fused(model: Model, text: np.ndarray, runs: np.ndarray, declared: list, suffixes: list, priors: list) -> tuple[list, np.ndarray, np.ndarray]:
    """(language, its posterior, whether accepted) of each row."""
    real = model.languages[:-1]
    n = len(real)
    log = text * (TEMPER * np.minimum(1.0, MOST_RUNS / np.maximum(runs, 1)))[:, None]
    even = 1.0 / max(n, 1)
    for k in range(len(runs)):
        p = np.full(n + 1, even)
        if priors[k] is not None:
            p[:n] = priors[k]
        if declared[k] in real:
            p[:n] *= np.where(np.arange(n) == real.index(declared[k]), DECLARED, (1 - DECLARED) / max(n - 1, 1))
            p[n] *= even
        spoken = SUFFIX_LANGUAGE.get(suffixes[k])
        if spoken in real:
            p[:n] *= np.where(np.arange(n) == real.index(spoken), SUFFIX, (1 - SUFFIX) / max(n - 1, 1))
            p[n] *= even
        log[k] += np.log(p)
    log -= log.max(axis=1, keepdims=True)
    post = np.exp(log)
    post /= post.sum(axis=1, keepdims=True)
    best = post.argmax(axis=1)
    best[runs == -2] = n
    sure = post[np.arange(len(best)), best]
    return [model.languages[b] for b in best], sure, (best != n) & (sure >= SURE)


JUDGED = "language string, posterior double, kept boolean"


def _suffix(host: str | None) -> str | None:
    return host.rpartition(".")[2] if host and "." in host else None


def _beside(batch: pa.RecordBatch, width: int, found: tuple[list, np.ndarray, np.ndarray]) -> pa.RecordBatch:
    """The first width columns of a batch, and language, posterior and kept."""
    languages, sure, kept = found
    cols = [*batch.columns[:width], pa.array(languages, pa.string()), pa.array(np.round(sure, 6), pa.float64()), pa.array(kept, pa.bool_())]
    return pa.RecordBatch.from_arrays(cols, names=[*batch.schema.names[:width], "language", "posterior", "kept"])


def _judged(docs: DataFrame, model: Model, text: Column, declared: Column, host: Column, priors: DataFrame, finish: Callable, schema) -> DataFrame:
    """Rows judged where they are, batch by batch, with priors broadcast; finish(batch of all columns of docs, found) makes the result."""
    width = len(docs.columns)
    t, f, d, h, of, prior = fresh(docs, "_ms_text", "_ms_fold", "_ms_declared", "_ms_host", "_ms_of", "_ms_prior")
    rows = docs.select(*[F.col(f"`{c}`") for c in docs.columns], text.alias(t), fold_of(text).alias(f), declared.alias(d), host.alias(h))
    rows = rows.join(F.broadcast(priors.select(F.col("of").alias(of), F.col("prior").alias(prior))), F.col(h).eqNullSafe(F.col(of)), "left").drop(of)
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def make() -> Callable:
        def one(batch):
            texts, folds, declared, hosts, priors = (batch.column(width + k).to_pylist() for k in range(5))
            found, runs = folded([prepared(t) for t in texts], folds, shipped.value.tables)
            return finish(batch.select(list(range(width))), fused(shipped.value, found, runs, declared, list(map(_suffix, hosts)), priors))

        return one

    return arrow_map(rows, make, schema)


def _judged_apart(keys: DataFrame, model: Model, priors: DataFrame) -> DataFrame:
    """keys: key, text, declared, host. key, language, posterior and kept; texts stay where they are, their likelihoods meet the priors."""
    shipped = keys.sparkSession.sparkContext.broadcast(model)
    key_type = keys.schema["key"].dataType.simpleString()

    def read() -> Callable:
        def one(batch):
            found, runs = folded([prepared(t) for t in batch.column(1).to_pylist()], batch.column(2).to_pylist(), shipped.value.tables)
            cols = [batch.column(0), batch.column(3), batch.column(4), pa.array(list(found), pa.list_(pa.float64())), pa.array(runs, pa.int64())]
            return pa.RecordBatch.from_arrays(cols, names=["key", "declared", "host", "logs", "runs"])

        return one

    def judge() -> Callable:
        def one(batch):
            declared, hosts, logs, runs, priors = (batch.column(k).to_pylist() for k in range(1, 6))
            return _beside(batch, 1, fused(shipped.value, np.array(logs, np.float64), np.array(runs), declared, list(map(_suffix, hosts)), priors))

        return one

    rows = keys.select("key", "text", fold_of(F.col("text")).alias("fold"), "declared", "host")
    rows = arrow_map(rows, read, f"key {key_type}, declared string, host string, logs array<double>, runs long")
    rows = rows.join(priors, F.col("host").eqNullSafe(F.col("of")), "left").drop("of")
    return arrow_map(rows, judge, f"key {key_type}, {JUDGED}")


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text: Column | None = None, declared: Column | None = None, host: Column | None = None) -> DataFrame:
    """doc_id, language, posterior and kept for each row. By default text, lang and source of documents."""
    text = F.col("text") if text is None else text
    declared = F.col("lang") if declared is None else declared
    host = F.col("source") if host is None else host
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("key"), text.alias("text"), declared.alias("declared"), host.alias("host"))
    priors = host_priors(rows.select("host", "declared"), model.languages)
    if priors.count() > MOST_HOSTS_BROADCAST:
        return _judged_apart(rows, model, priors).withColumnRenamed("key", "doc_id")
    out = _judged(rows, model, F.col("text"), F.col("declared"), F.col("host"), priors, lambda batch, found: _beside(batch.select([0]), 1, found), f"doc_id long, {JUDGED}")
    return out


def accepted(docs: DataFrame, model: Model | None = None, text_col: str = "text", declared_col: str = "lang", host_col: str = "source") -> DataFrame:
    """The rows whose language is told for certain enough, with all their columns; texts aren't shuffled, but for those that go."""
    model = model or fit(docs, text_col, declared_col)
    text, declared, host = (F.col(f"`{c}`") for c in (text_col, declared_col, host_col))
    priors = host_priors(docs.select(host.alias("host"), declared.alias("declared")), model.languages)
    if priors.count() <= MOST_HOSTS_BROADCAST:
        return _judged(docs, model, text, declared, host, priors, lambda batch, found: batch.filter(pa.array(found[2], pa.bool_())), docs.schema)
    # rows alike in all that is judged are judged alike, so what is judged can be the key
    told = F.sha2(F.to_json(F.array(*[F.coalesce(F.concat(F.lit("="), c), F.lit("-")) for c in (text, declared, host)])), 256)
    apart = _judged_apart(docs.select(told.alias("key"), text.alias("text"), declared.alias("declared"), host.alias("host")), model, priors)
    gone = stored(apart.filter("not kept").select("key").distinct(), "gone")
    (row,) = fresh(docs, "_ms_row")
    return bloom.without(docs.withColumn(row, told), row, gone, "key", gone.count()).drop(row)


def of_pages(pages: DataFrame, model: Model, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, language, posterior and kept of web pages: text and declared language of the markup, suffix and host of the address."""
    text, declared, host = markup_evidence(pages, url_col, html_col)
    return identify(pages, model, id_col, text, declared, host).withColumnRenamed("doc_id", "page_id")


def markup_evidence(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> tuple[Column, Column, Column]:
    """(text, declared language, host) of web pages: tags out, the lang attribute of html, the address's host."""
    html = F.coalesce(F.col(f"`{html_col}`"), F.lit(""))
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->|<[^>]*>|&[a-zA-Z#0-9]+;", " ")
    lang = F.lower(F.regexp_extract(html, r"(?is)<html[^>]*?\blang\s*=\s*[\"']?([a-zA-Z]{2,3})", 1))
    host = F.lower(F.regexp_extract(F.coalesce(F.col(f"`{url_col}`"), F.lit("")), r"://([^/?#]*)", 1))
    return bare, F.when(lang != "", lang), host
