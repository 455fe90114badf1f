"""Spot signatures against plain Python and against their SQL."""

import hashlib
import itertools
import random
import time

import duckdb
from pyspark.sql import functions as F

from linkloom.llm import spot_signatures as S
from linkloom.llm.queries import ORACLE, op13_spot_signatures

SMALL = "/root/testdata/sf0.001"


def plain_set(text):
    words = text.lower().replace("\t", " ").replace("\n", " ").split()
    found = set()
    for i in range(-1, len(words)):
        here = words[i] if i >= 0 else ""
        if i >= 0 and (here not in S.ANCHORS or words[i + 1 : i + 2] and words[i + 1] in S.ANCHORS):
            continue
        chain = list(itertools.islice((w for w in words[i + 1 : i + 400] if w not in S.ANCHORS), S.CHAIN))
        if here or chain:
            found.add(hashlib.md5(" ".join([here, *chain]).encode()).hexdigest()[: S.DIGITS])
    return found


def plain_likeness(a, b):
    if a == b:
        return 1.0
    both = len(a & b) / len(a | b)
    return both if both >= S.LEAST else 0.0


def plain(rows):
    """The contract over (doc_id, text) rows in plain Python."""
    rows = sorted(((i, t or "") for i, t in rows if i is not None), key=lambda r: (-r[0], r[1].encode()))
    out = []
    for k, (doc, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own, other, following = plain_set(text), plain_set(edited), plain_set(after)
        out.append((
            doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), "".join(sorted(own)), "".join(sorted(other)),
            plain_likeness(own, other), plain_likeness(own, following),
        ))
    return sorted(out)


COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def rows_of(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def test_signatures(spark):
    def of(text):
        df = spark.createDataFrame([(text,)], "text string")
        return df.select(S.spot_signatures(F.col("text"))).first()[0]

    assert of("The house of the cards fell over the hill. Is") == [
        " house cards fell", "the house cards fell", "the cards fell over", "the hill.", "is",
    ]
    assert of("one two\t three \n four") == [" one two three"]
    assert of("the of THE") == ["the"] and of("theory of") == [" theory", "of"]
    assert of("") == of(" \n\t ") == []
    assert of("the \x01a b") == ["the \x02a b"] or of("the \x01a b")[-1] == "the \x02a b"


def test_query_equals_plain_python(spark):
    rows = duckdb.sql(f"select doc_id, text from '{SMALL}/documents.parquet'").fetchall()
    assert rows_of(op13_spot_signatures(spark, SMALL)) == plain(rows)
    shown = op13_spot_signatures(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in shown and "Arrow" not in shown and "Pandas" not in shown
    assert shown.count("Exchange hashpartitioning") == 1 and "Join" not in shown


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SMALL}/documents.parquet'")
    found = con.execute(ORACLE["op13_spot_signatures"])
    names = [d[0] for d in found.description]
    expected = sorted(tuple(r[names.index(c)] for c in COLUMNS) for r in found.fetchall())
    assert rows_of(op13_spot_signatures(spark, SMALL)) == expected


def test_ranges_and_odd_rows(spark, monkeypatch):
    rng = random.Random(2)
    words = ["the", "of", "la", "y", "ä", "Ünd", "x", "zebra", "und", "a.", "\x0b", "😀"]
    schema = "doc_id long, text string, _range int, fingerprint string"
    rows = [(i * 37 - 4000 + (i > 150) * 10**15, " ".join(rng.choices(words, k=rng.randrange(30))), 7, "clash") for i in range(300)]
    rows += [(10**16, None, 1, None), (10**16 + 1, "", 1, None), (-(2**62), "the " * 100_000 + "end", 1, None), rows[5], rows[5]]
    df = spark.createDataFrame(rows, schema)
    for size in (512, 7, 1):
        monkeypatch.setattr(S, "RANGE_ROWS", size)
        assert rows_of(S.spot_fingerprints(df)) == plain([r[:2] for r in rows])
    (alone,) = S.spot_fingerprints(spark.createDataFrame([(5, "the cat sat", 1, "")], schema)).collect()
    assert alone.near_next == 1.0 and 0 <= alone.near_edited <= 1
    unnamed = S.spot_fingerprints(spark.createDataFrame([(None, "the cat sat", 1, ""), (None, None, 1, ""), (3, "x", 1, "")], schema))
    assert sorted((r.n_chars, r.near_next) for r in unnamed.collect()) == [(0, 1.0), (1, 1.0), (11, 1.0)]
    assert S.spot_fingerprints(spark.createDataFrame([], schema)).count() == 0


def test_long_texts_take_linear_time(spark):
    texts = ["the " * 200_000, "x" * 1_000_000, "the x " * 150_000, " " * 1_000_000, "the of x y z w " * 60_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    started = time.time()
    S.spot_fingerprints(df).collect()
    assert time.time() - started < 60


def test_given_pairs(spark):
    rng = random.Random(4)
    docs = [(i, " ".join(rng.choices(["the", "of", "cat", "sat", "mat", "on", "dog"], k=rng.choice([2, 20, 400])))) for i in range(30)]
    pairs = [(i, j) for i in range(30) for j in range(i)]
    for least in (0.05, 0.5):
        found = S.near_pairs(spark.createDataFrame(pairs, "a long, b long"), spark.createDataFrame(docs, "doc_id long, text string"), least)
        sets = {i: plain_set(t) for i, t in docs}
        expected = {(i, j) for i, j in pairs if sets[i] == sets[j] or len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j])}
        assert {(r.a, r.b) for r in found.collect()} == expected
