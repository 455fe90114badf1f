"""The pipeline, stage by stage, on rows with planted cases and on the given tables."""

import re

import numpy as np
import public_tokenizers
import sentencepiece

import __spark_entry__ as entry_point
import corpus_pipeline as C
from linkloom.llm.queries import ORACLE, QUERIES

ROOT = "/root/testdata/sf0.001"


def test_all_queries_are_registered():
    registered = entry_point.queries()
    assert set(QUERIES) <= set(registered) and "pipeline" in registered
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)


def test_stages_hand_on_documents(spark):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.collect()}
    for name, stage in C.STAGES[:-1]:
        docs = stage(spark, docs, ROOT)
        assert docs.columns == columns, name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        kept = {r.doc_id for r in docs.collect()}
        assert kept <= ids
        ids = kept
    texts = {r.doc_id: r.text for r in docs.collect()}
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    final = {r.doc_id: r.n_tokens for r in C.STAGES[-1][1](spark, docs, ROOT).collect()}
    assert final == {i: len(model.encode(t)) + 2 for i, t in texts.items()}
    assert {r.doc_id: r.n_tokens for r in C.run(spark, ROOT).collect()} == final


def test_clean_documents_stay_and_planted_ones_go(spark):
    rng = np.random.default_rng(2)
    given = spark.read.parquet(f"{ROOT}/documents.parquet").join(spark.read.parquet(f"{ROOT}/labels.parquet").where("quality = 1"), "doc_id").limit(40).collect()
    bench = spark.read.parquet(f"{ROOT}/benchmark.parquet").first().text
    fresh = lambda: " ".join(f"w{rng.integers(10**9)} of the" for _ in range(30)) + "."
    base = fresh()
    rows = [(1, base), (2, base), (3, base + " one two"), (4, fresh() + "\n" + bench), (5, fresh() + '\npassword = "Zk29dk30dk39"'), (6, fresh()), (None, fresh()), (8, None), (6, None)]
    rows[8] = rows[5]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    after = C.dedup(spark, docs, ROOT)
    assert sorted((r.doc_id or 0) for r in after.collect()) == [0, 1, 4, 5, 6, 8]
    after = C.decontamination(spark, docs, ROOT)
    assert 4 not in {r.doc_id for r in after.collect()} and after.count() == len(rows) - 1
    redacted = {r.doc_id: r.text for r in C.secret_redaction(spark, docs, ROOT).collect()}
    assert "Zk29dk30dk39" not in redacted[5] and redacted[1] == base
    clean = spark.createDataFrame([(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in given], docs.schema)
    assert C.quality(spark, clean, ROOT).count() >= clean.where("size(split(text, ' ')) > 30").count() * 0.95 - 3


def test_rows_without_an_id_or_with_one_id_for_two_texts(spark):
    rng = np.random.default_rng(4)
    bench = spark.read.parquet(f"{ROOT}/benchmark.parquet").first().text
    fresh = lambda: " ".join(f"w{rng.integers(10**9)} of the" for _ in range(30)) + "."
    base, one, two, alone = fresh(), fresh(), fresh(), fresh()
    rows = [(None, base), (4, base + " one"), (9, base), (5, one), (5, two), (None, alone), (None, alone + " x"), (None, bench), (6, bench), (7, None), (None, None), (7, None), (8, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, first int")
    after = C.dedup(spark, docs, ROOT)
    assert after.columns == docs.columns
    got = sorted(((r.doc_id or 0), r.text or "") for r in after.collect())
    lone = [g for g in got if g[0] == 0 and g[1].startswith(alone)]
    assert len(lone) == 1
    assert sorted(g for g in got if g not in lone) == sorted([(4, base + " one"), (5, one), (5, two), (6, bench), (7, ""), (0, ""), (8, "")])
    after = C.decontamination(spark, docs, ROOT)
    assert after.columns == docs.columns
    assert sorted(((r.doc_id or 0), r.text or "") for r in after.collect()) == sorted((i or 0, t or "") for i, t in rows if t != bench)


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet").limit(0)
    for name, stage in C.STAGES:
        assert stage(spark, docs, ROOT).count() == 0, name
