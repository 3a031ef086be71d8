"""run() against a plain version of the stages after the first."""

import zlib

import numpy as np
import public_tokenizers
from test_near_dedup import brute_classes
from tokenizers import Tokenizer

import corpus_pipeline
from marlstone.llm.decontaminate import words_of


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    known = corpus_pipeline.keep_known_languages(spark, docs, sf_dir)
    assert known.columns == docs.columns
    rows = {r.doc_id: r.text for r in known.collect()}
    assert len(rows) >= 0.99 * docs.count()
    last = {}
    for i in sorted(rows):
        last[rows[i]] = i
    rows = {i: rows[i] for i in sorted(last.values())}
    heads = set(brute_classes(list(rows.items())).values())
    windows, short = set(), []
    for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect():
        item = words_of(r.text)
        assert len(item) >= 13 or not item or short.append(item) is None
        windows |= {tuple(item[k : k + 13]) for k in range(len(item) - 12)}
    assert not short
    kept = {}
    for i in heads:
        words, hit = words_of(rows[i]), set()
        for k in range(len(words) - 12):
            if tuple(words[k : k + 13]) in windows:
                hit.update(range(k, k + 13))
        if not (hit and 20 * len(hit) >= len(words)):
            kept[i] = rows[i]
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    want = {}
    for i, text in kept.items():
        ids = np.array([*tok.encode(text, add_special_tokens=False).ids, 2], "<u4")
        n = len(ids)
        cuts = [0, *range(n % 1024 or 1024, n, 1024), n] if n > 1024 else [0, n]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want[i, k] = (a, b - a, zlib.crc32(ids[a:b].tobytes()))
    got = corpus_pipeline.run(spark, sf_dir).toPandas()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got.itertuples()} == want
    got = got.sort_values(["sequence_id", "offset"])
    assert (got.groupby("sequence_id").length.cumsum() - got.length == got.offset).all()
    assert got.groupby("sequence_id").length.sum().max() <= 1024
    assert got.sequence_id.nunique() <= 1.01 * -(-got.length.sum() // 1024) + 1


def test_stages_on_odd_tables(spark, sf_dir):
    """Nulls in every column, repeated rows, columns whose names the operators use themselves, and an empty table."""
    text = "The was and of in the thing that was with the other one and more of it than of this"
    rows = [(1, text, "en", "a", 3, None), (2, text, "en", "a", 3, "x"), (2, text, "en", "a", 3, "x"), (3, text + " also", None, None, None, "x"), (None, None, None, None, None, None), (5, "", "en", "a", 0, "x"), (6, text.upper(), "en", "a", 1, "x")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, {} string"
    for name in ("digest", "bucket", "node", "label", "contaminated"):
        docs = spark.createDataFrame(rows, schema.format(name))
        for _, stage in corpus_pipeline.STAGES[:2] + corpus_pipeline.STAGES[3:4]:
            out = stage(spark, docs, sf_dir)
            assert out.columns == docs.columns and out.count() <= len(rows)
    docs = spark.createDataFrame(rows, schema.format("node"))
    kept = corpus_pipeline.drop_near_copies(spark, docs, sf_dir)
    # 3 has one word more than 1, 6 is in capitals; a null text is in the class of the empty one
    got = sorted((r.doc_id for r in kept.collect()), key=repr)
    assert kept.columns == docs.columns and 1 in got and 5 in got and not {2, 3, 6} & {*got}
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), sf_dir).count() == 0
    assert corpus_pipeline.pack_sequences(spark, docs, sf_dir).count() == len(rows)
