"""Names of a list found in texts: word n-grams meet a table of phrases; of overlapping names the leftmost and longest stay.

The table of phrases is sent to all tasks below MOST_SENT rows, counted; a bigger one is dealt out by phrase like the n-grams. Case and what stands between words don't matter; words are runs of letters and digits.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_SENT = 100_000
PIECE = r"[^\p{L}\p{N}]*[\p{L}\p{N}]+"  # a word with what stands before it
GAP = r"^[^\p{L}\p{N}]+"


def plain_words(text: Column) -> Column:
    """The words of a text in lower case."""
    return F.transform(F.regexp_extract_all(text, F.lit(PIECE), F.lit(0)), lambda p: F.lower(F.regexp_replace(p, GAP, "")))


def _leftmost(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the spans (word, number of words, gram) of each text the leftmost and longest ones that don't overlap, by their characters."""
    word = regex.compile(r"[\p{L}\p{N}]+")
    for batch in batches:
        rows, starts, ends, grams = [], [], [], []
        for k, (text, spans) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
            at, end = [m.span() for m in word.finditer(text)], 0
            for s in sorted(spans, key=lambda s: (s["i"], -s["n"])):
                if s["i"] >= end:
                    end = s["i"] + s["n"]
                    rows.append(k)
                    starts.append(at[s["i"]][0])
                    ends.append(at[end - 1][1])
                    grams.append(s["gram"])
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(starts, pa.int32()), pa.array(ends, pa.int32()), pa.array(grams, pa.string())], names=["text_id", "start", "end", "gram"])


def found_names(texts: DataFrame, phrases: DataFrame) -> DataFrame:
    """texts: text_id, text, no id twice; phrases: phrase and other columns. One row for each name found: text_id, start, end (characters, from 0, end exclusive), and the phrases' columns.

    A phrase listed several times gives as many rows for a place."""
    other = [c for c in phrases.columns if c != "phrase"]
    table = phrases.withColumn("gram", F.array_join(plain_words(F.col("phrase")), " ")).filter("gram <> ''")
    table = table.withColumn("length", F.size(F.split("gram", " ")))
    longest, rows = table.agg(F.max("length"), F.count("*")).first()
    if not rows:
        return texts.select("text_id", F.lit(0).alias("start"), F.lit(0).alias("end")).limit(0).join(phrases.limit(0))
    words = texts.filter("text is not null").select("text_id", plain_words(F.col("text")).alias("words"))
    lengths = F.array(*map(F.lit, sorted(r.length for r in table.select("length").distinct().collect())))
    made = F.flatten(F.transform(lengths, lambda n: F.filter(F.transform(F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.struct(i.alias("i"), n.alias("n"), F.when(i + n <= F.size("words"), F.array_join(F.slice("words", i + 1, n), " ")).alias("gram"))), lambda g: g["gram"].isNotNull())))
    grams = words.filter("size(words) > 0").select("text_id", F.explode(made).alias("g")).select("text_id", "g.i", "g.n", "g.gram")
    listed = table.select("gram").distinct()
    met = grams.join(F.broadcast(listed) if rows <= MOST_SENT else listed, "gram")
    spans = met.groupBy("text_id").agg(F.collect_list(F.struct("i", "n", "gram")).alias("spans"))
    kind = spans.schema["text_id"].dataType.simpleString()
    spans_at = spans.join(texts.select("text_id", "text"), "text_id").select("text_id", "text", "spans").mapInArrow(_leftmost, f"text_id {kind}, start int, end int, gram string")
    facts = table.select("gram", *other)
    return spans_at.join(F.broadcast(facts) if rows <= MOST_SENT else facts, "gram").select("text_id", "start", "end", *other)
