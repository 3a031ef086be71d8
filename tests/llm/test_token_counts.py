"""Sections' counts against the offsets that the tokenizers library gives."""

import random

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marlstone.llm.bpe import encoder, vocabulary
from marlstone.llm.token_counts import count, joined_fields


def test_ids_equal_the_json_form():
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    rng = random.Random(5)
    bits = ["a", "word", " ", "\n", "\t", "'s", "é", "12", "!", "日本", "́", "\x00", "\x85", "\x1c", "<|endoftext|>", ".", "　"]
    ours = encoder(vocabulary())
    for _ in range(4000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 16)))
        assert list(memoryview(ours.ids(text)).cast("I")) == tok.encode(text, add_special_tokens=False).ids, repr(text)


def brute(text, rule, tok):
    lines = text.split("\n")
    bounds, at = [], 0
    for k, line in enumerate(lines):
        end = at + len(line) + (k < len(lines) - 1)
        if end > at or not text:
            bounds.append((at, end))
        at = end
    out = [0] * len(bounds)
    for a, b in tok.encode(text, add_special_tokens=False).offsets:
        inside = [max(0, min(b, e) - max(a, s)) for s, e in bounds]
        touched = [k for k, x in enumerate(inside) if x]
        out[{"start": touched[0], "end": touched[-1], "majority": inside.index(max(inside))}[rule]] += 1
    return [(*s, n) for s, n in zip(bounds, out, strict=True)]


def test_sections(spark, sf_dir):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    extra = [(-1, "a\n\n\nb \n c"), (-2, ""), (-3, "é\n日本\n"), (-4, "\n\n"), (-5, "x.\n\n\n\n\ny")]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").filter("doc_id < 120")
    docs = docs.union(spark.createDataFrame(extra, docs.schema))
    texts = {r.doc_id: r.text for r in docs.collect()}
    for rule in ("start", "end", "majority"):
        got = {}
        for r in count(docs, rule=rule).orderBy("section").collect():
            got.setdefault(r.doc_id, []).append((r.char_begin, r.char_end, r.n_tokens))
        for i, t in texts.items():
            assert got[i] == brute(t, rule, tok), (rule, t[:80])


def test_fields_and_edges(spark):
    rows = spark.createDataFrame([(1, None, "web"), (2, "one two", None), (2, "one two", None), (None, "x", "y")], "doc_id long, text string, section string")
    text, sections = joined_fields(rows, ["section", "text"])
    got = count(rows.withColumn("whole", text).withColumn("parts", sections), text_col="whole", sections=F.col("parts"))
    assert sorted(((r.doc_id, r.section, r.n_tokens) for r in got.collect()), key=repr) == sorted(
        [(1, 0, 2), (1, 1, 0), (2, 0, 1), (2, 0, 1), (2, 1, 2), (2, 1, 2), (None, 0, 2), (None, 1, 1)], key=repr
    )
    assert [(r.n_tokens, r.doc_tokens) for r in count(rows.filter("doc_id = 1")).collect()] == [(0, 0)]
    assert count(rows.limit(0)).count() == 0
