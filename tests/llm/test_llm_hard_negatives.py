"""Hard negatives against all pairs, the bounds against true scores, and the query against its SQL."""

import math
import random

import duckdb
import numpy as np
import pytest

from linkloom.llm import hard_negatives as H
from linkloom.llm.queries import ORACLE, op11_hard_negatives

SMALL = "/root/testdata/sf0.01"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
SCHEMA = "vec_id long, label int, embedding array<float>, q string, rank int"


def rows_of(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def plain(rows):
    """All pairs in plain Python integers."""
    usable = {}
    for vec_id, label, vec in rows:
        if None in (vec_id, label) or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        vec = [float(np.float32(x)) for x in vec]
        usable[vec_id] = min(usable.get(vec_id, (label, vec)), (label, vec))
    done = {}
    for vec_id, (label, vec) in usable.items():
        q = [max(-H.LARGEST, min(H.LARGEST, math.floor(256 * x))) for x in vec]
        done[vec_id] = ((label + 1) % 10 if vec_id % 7 == 0 else label, q)
    out = []
    for a, (label, q) in done.items():
        if a % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, r)), b, other) for b, (other, r) in done.items() if b != a)
        for s, p, _ in [x for x in scored if x[2] == label][:5]:
            fit = [x for x in scored if x[2] != label and -80 * s <= -100 * x[0] <= -100 * s][:5]
            out += [(a, p, i + 1, n, -s, -t) for i, (t, n, _) in enumerate(fit)]
    return sorted(out)


@pytest.mark.parametrize("dim", [1, 3, 64, 65, 200])
def test_bounds_hold(dim):
    rng = np.random.default_rng(dim)
    q = (rng.standard_normal((400, dim)) * rng.choice([1, 40, 1e5], (400, 1))).astype(np.int64)
    q[:3] = 0
    q[3:6] = q[6:9]
    q[9, :] = H.LARGEST
    anchors = H.Anchors(np.arange(400), np.zeros(400, np.int64), q)
    code, align, rest = H.encoded(q)
    low, high = anchors.bounds(slice(0, 400), code, align, rest)
    true = (q @ q.T).astype(np.float64)
    assert (low <= true).all() and (true <= high).all()
    size = np.sqrt((q * q).sum(1).astype(np.float64))
    if dim >= 64:  # and they tell something: narrower than the norms alone
        assert ((high - low)[20:, 20:] < 1.7 * size[20:, None] * size[20:]).mean() > 0.9


def test_rotation_is_a_rotation():
    r = H.rotation(64)
    assert np.allclose(r @ r.T, np.eye(64)) and (H.rotation(64) == r).all()


def test_query_equals_all_pairs_and_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SMALL}/embeddings.parquet'")
    found = rows_of(op11_hard_negatives(spark, SMALL))
    assert len(found) > 50
    assert found == plain(con.execute("select vec_id, label, embedding from embeddings").fetchall())
    sql = con.execute(f"select {', '.join(COLUMNS)} from ({ORACLE['op11_hard_negatives']})").fetchall()
    assert found == sorted(sql)


def odd_rows(rng):
    """Few distinct small vectors, so that scores tie, with copies, faults, lengths and negative ids."""
    rows = []
    for i in range(-300, 900):
        vec = [rng.choice([-0.3, 0.0, 0.1, 0.2, 0.25]) for _ in range(rng.choice([6, 6, 6, 4, 0]))]
        rows.append((i, rng.randrange(10) if rng.random() < 0.7 else 3, vec))
    for i in rng.sample(range(len(rows)), 60):
        vec_id, label, vec = rows[i]
        fault = rng.randrange(6)
        rows[i] = [
            (vec_id, None, vec), (vec_id, label, None), (vec_id, label, [None, 1.0]), (vec_id, label, [float("nan")] + vec),
            (None, label, vec), (vec_id, label, [float("inf")]),
        ][fault]
    rows += rows[:40] + [(5, 1, [0.5]), (7, 2, [1e30, -1e30])]
    rng.shuffle(rows)
    return rows


def test_odd_rows(spark, monkeypatch):
    rng = random.Random(8)
    rows = odd_rows(rng)
    df = spark.createDataFrame([(*r, "clash", 0) for r in rows], SCHEMA)
    expected = plain(rows)
    assert len(expected) > 100 and rows_of(H.hard_negatives(df)) == expected
    for name, value in (("ANCHORS_AT_ONCE", 4), ("BLOCK_ANCHORS", 3), ("BLOCK_ROWS", 50)):
        monkeypatch.setattr(H, name, value)
    assert rows_of(H.hard_negatives(df.repartition(3))) == expected


def test_nothing_to_find(spark):
    for rows in ([], [(0, 1, [0.5], "", 0)], [(100, 1, None, "", 0), (200, None, [1.0], "", 0)], [(0, 1, [], "", 0), (1, 1, [], "", 0)]):
        assert H.hard_negatives(spark.createDataFrame(rows, SCHEMA)).collect() == []
