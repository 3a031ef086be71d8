"""Table-valued text operators: windows over a text, sections by headings, quality gates, declarative rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X


def windows(docs: DataFrame, id_col: str, text_col: str, size: int = 2000, overlap: int = 300, least: int = 120) -> DataFrame:
    """chunk_id, chunk_index, char_start, char_end, chunk of each text.

    Windows start every size - overlap characters up to the first that reaches the end; those with fewer than `least` characters besides white space are left out,
    and only emitted ones are numbered.
    """
    step = size - overlap
    n = F.length(text_col)
    last = F.greatest(F.ceil((n - size) / step), F.lit(0))
    starts = F.transform(F.sequence(F.lit(0).cast("long"), last), lambda k: k * step)
    chunk = lambda s: F.substring(F.col(text_col), (s + 1).cast("int"), F.lit(size))
    kept = F.filter(F.transform(starts, lambda s: F.struct(s.alias("s"), chunk(s).alias("c"))), lambda x: F.length(F.regexp_replace(x["c"], r"^\s+|\s+$", "")) >= least)
    rows = docs.filter(F.col(text_col).isNotNull()).select(id_col, n.alias("_n"), F.posexplode(kept).alias("chunk_index", "x"))
    return rows.select(
        F.concat(F.col(id_col).cast("string"), F.lit("::c"), F.col("chunk_index").cast("string")).alias("chunk_id"), F.col(id_col), "chunk_index",
        F.col("x.s").alias("char_start"), F.least(F.col("x.s") + size, F.col("_n").cast("long")).alias("char_end"), F.col("x.c").alias("chunk"),
    )


def sections(lines: DataFrame, doc: str, ord_col: str, line: str, heading: Column) -> DataFrame:
    """Lines gathered under the heading before them: doc, section, n_lines, body. Lines before the first heading are section ''.

    `heading` gives the heading of a line or null. Each document's lines are few enough to be in one group.
    """
    from pyspark.sql import Window

    w = Window.partitionBy(doc).orderBy(ord_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    named = lines.withColumn("_h", heading).withColumn("section", F.coalesce(F.last("_h", ignorenulls=True).over(w), F.lit(""))).filter("_h is null")
    grouped = named.groupBy(doc, "section").agg(F.count("*").alias("n_lines"), F.array_sort(F.collect_list(F.struct(ord_col, line))).alias("_l"))
    return grouped.select(doc, "section", "n_lines", F.array_join(F.col("_l")[line], "\n").alias("body"))


# Texts that a reader leaves where it couldn't read.
UNREADABLE = r"(?i)\[MISSING\]|\[ILLEGIBLE\]|\[UNK\]"
REJECT_BELOW, ENTROPY_LEAST, CHARS_LEAST, REPEATED_MOST, LATEX_MOST = 0.35, 3.0, 15, 0.15, 0.25


def quality_gate(c: Column) -> tuple[Column, Column]:
    """(score, flags) of a text: 1 less the penalties of what is wrong with it, between 0 and 1.

    An empty text has score 0. Penalties: too short .40; a loop .55 (its start again and again, or one run of five words too often), .20 more if both and
    severe; little entropy .10 to .30; unreadable marks .25; too many formula signs .20.
    """
    body = F.regexp_replace(c, r"^\s+|\s+$", "")

    def judged(p: Column) -> Column:
        t = p["t"]
        return F.struct(
            t.alias("t"), F.length(t).alias("n"), p["e"].alias("e"), X.top_gram_ratio(t).alias("r"), X.loops_on_its_start(t).alias("start"),
            t.rlike(UNREADABLE).alias("marks"), X.symbol_density(t).alias("signs"),
        )

    def scored(q: Column) -> Column:
        short, loop, low = q["n"] < CHARS_LEAST, q["start"] | (q["r"] > REPEATED_MOST), q["e"] < ENTROPY_LEAST
        flags = F.array_compact(F.array(F.when(short, "TOO_SHORT"), F.when(loop, "REPETITION_LOOP"), F.when(low, "LOW_ENTROPY"), F.when(q["marks"], "UNREADABLE"), F.when(q["signs"] > LATEX_MOST, "LATEX_OVERFLOW")))
        off = lambda cond, by: F.when(cond, by).otherwise(F.lit(0.0))
        loss = off(short, 0.40) + off(loop, 0.55) + off(q["start"] & (q["r"] > 0.40), 0.20) + off(low, F.greatest(F.lit(0.10), 0.30 * (1 - q["e"] / ENTROPY_LEAST))) + off(q["marks"], 0.25) + off(q["signs"] > LATEX_MOST, 0.20)
        empty = F.struct(F.lit(0.0).alias("score"), F.array(F.lit("EMPTY")).alias("flags"))
        return F.when(q["n"] == 0, empty).otherwise(F.struct(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1.0 - loss)).alias("score"), flags.alias("flags")))

    whole = F.coalesce(body, F.lit(""))
    out = X.once(X.once(F.struct(whole.alias("t"), X.entropy(whole).alias("e")), judged), scored)
    return out["score"], out["flags"]
