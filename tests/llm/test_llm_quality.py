"""Base measures against plain Python; the field against enumeration of all label sequences; verdicts on the given tables."""

import itertools
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from linkloom.llm import quality_crf as Q
from linkloom.llm.textcols import texts_of

FLAT = Q.LineModel(np.zeros(len(Q.FEATURES) * Q.BINS), np.zeros((2, 2)), np.array([0.0, 1.0]))
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    words = WORD.findall(text)
    spots = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen = Counter(spots)
    covered = {k for i, s in enumerate(spots) if seen[s] > 1 for k in range(i, i + 8)}
    lines, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def measured(texts):
    out = Q.judge(texts_of(pa.array(texts, pa.string())), FLAT, 0.5)
    return [tuple(int(out[k][i]) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) for i in range(len(texts))]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab é\n\t\r\x0b\x1c #|😀", max_size=60), min_size=1, max_size=5))
def test_base_measures(texts):
    texts = [*texts, *(t * 5 for t in texts)]
    assert measured(texts) == [plain(t) for t in texts]


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(0)
    for n in (1, 2, 5):
        model = Q.LineModel(FLAT.emit, rng.normal(size=(2, 2)), rng.normal(size=2))
        lengths = [n, 3, 0, 1]
        score = rng.normal(size=sum(lengths)) * 2
        got = Q.viterbi(score, np.repeat(np.arange(4), lengths), 4, model)
        at = 0
        for length in lengths:
            part = score[at : at + length]

            def value(path):
                return model.start[path[0]] + sum(part[i] for i, s in enumerate(path) if s) + sum(model.step[a, b] for a, b in zip(path, path[1:]))

            if length:
                assert tuple(got[at : at + length]) == max(itertools.product((0, 1), repeat=length), key=value)
            at += length


def test_verdicts_agree_with_labels(spark):
    root = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{root}/documents.parquet"), spark.read.parquet(f"{root}/labels.parquet")
    rows = Q.quality_rules(docs, labels).join(labels, "doc_id").where("not base_failed").collect()
    clean = [r.kept for r in rows if r.quality == 1]
    junk = [r.kept for r in rows if r.quality == 0]
    assert sum(clean) >= 0.99 * len(clean)
    assert sum(junk) <= 0.2 * len(junk)


def test_odd_rows(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame(
        [(1, None, True), (2, "", True), (None, "a " * 30, True), (4, "word " * 5, False), (5, " ".join(map(str, range(30))), False), (5, " ".join(map(str, range(30))), False)],
        "doc_id long, text string, kept boolean",
    )
    got = sorted(((r.doc_id, r.n_words, r.base_failed, r.kept) for r in Q.quality_rules(docs, labels).collect()), key=str)
    assert got == [(1, 0, True, False), (2, 0, True, False), (4, 5, True, False), (5, 30, False, True), (5, 30, False, True), (None, 30, True, False)]
    kept = Q.keep_quality(docs, labels)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [5, 5]
    assert Q.quality_rules(docs.limit(0), labels).count() == 0


def test_very_long_text(spark):
    text = "\n".join(f"line {k} has its own words {k * 7} and {k * 11}" for k in range(60_000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = Q.quality_rules(docs, spark.createDataFrame([], "doc_id long, quality int")).first()
    assert row.n_words == 60_000 * 9 and row.n_lines == 60_000 and row.n_dup_lines == 0
