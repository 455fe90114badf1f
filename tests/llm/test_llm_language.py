"""Held-out accuracy, calibration and odd rows of language identification."""

import time
import zlib

import numpy as np
import pyarrow as pa

from linkloom.llm import language as L
from linkloom.llm.textcols import texts_of


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id % 2 = 0")
    rows = L.identify_language(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows[:50])
    right = np.array([r.lang == r.lang_pred for r in rows])
    score = np.array([r.score for r in rows])
    assert right.mean() > 0.99
    assert abs(right.mean() - score.mean()) < 0.02
    kept = ~np.array([r.rejected for r in rows])
    assert kept.mean() > 0.9 and right[kept].mean() >= right.mean()


def test_inputs_are_text_only(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(300)
    model = L.fit_languages(docs)
    texts = [r.text for r in docs.limit(50).collect()]
    a = L.predict(texts_of(pa.array(texts)), model)
    b = L.predict(texts_of(pa.array(texts[::-1])), model)
    assert (a[0] == b[0][::-1]).all() and np.allclose(a[1], b[1][::-1])


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, "der und die " * 9, "de", 1.0), (2, "the and of " * 9, "en", 1.0), (3, None, None, 1.0), (4, "", "en", 1.0), (5, "123 !? 4", "en", 1.0), (6, "x", None, 1.0), (6, "x", None, 1.0), (None, "the and", "en", 1.0)],
        "doc_id long, text string, lang string, score double",
    )
    rows = L.identify_language(docs).collect()
    assert len(rows) == 8 and {r.doc_id for r in rows if r.lang_pred == "und"} == {3, 4, 5}
    assert all(r.score == 0 and r.rejected for r in rows if r.lang_pred == "und")
    assert all(0 <= r.score <= 1 for r in rows) and {r.lang_pred for r in rows} <= {"und", "de", "en"}
    nothing = L.identify_language(docs.withColumn("lang", docs.source if "source" in docs.columns else docs.lang.substr(9, 1)).where("lang is null")).collect()
    assert {r.lang_pred for r in nothing} <= {"und"}
    assert L.identify_language(docs.limit(0)).count() == 0


def test_subwords_stay_inside_texts_and_words():
    whole = L.subwords(texts_of(pa.array(["ab cd"])))
    assert len(whole[0]) == len(L.subwords(texts_of(pa.array(["ab", None, "", "cd"])))[0]) + 2  # the edges at the blank
    long = L.subwords(texts_of(pa.array(["wort " * 100_000])))
    assert (long[1] == 0).all() and len(long[0]) > 500_000


def test_bags_of_many_short_texts():
    """Each text's bag by itself, and in time linear in the texts."""
    lines = [f"wort {k} über die {k % 7} x" for k in range(30_000)] + ["", None, "12 34"]
    start = time.process_time()
    found = L.bags(texts_of(pa.array(lines)))
    assert time.process_time() - start < 8
    for i in (0, 1, 17, 29_999, 30_000, 30_001, 30_002):
        (alone,) = L.bags(texts_of(pa.array([lines[i]], pa.string())))
        assert np.array_equal(found[i][0], alone[0]) and np.array_equal(found[i][1], alone[1])
