import random
import re
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from linkloom.operators import frontier as FR
from linkloom.schemas import FRONTIER


def _rows(spark, rows):
    """Frontier rows from (url, priority, depth, parent, seconds, seq, status)."""
    full = [
        (u, p, d, parent, datetime.fromtimestamp(at, timezone.utc), seq, status, None)
        for u, p, d, parent, at, seq, status in rows
    ]
    return spark.createDataFrame(full, FRONTIER)


def _plain(df):
    return {
        (r.url, r.priority, r.depth, r.parent_url, r.seq, r.status) for r in df.collect()
    }


def test_seeds(spark):
    seeds = spark.createDataFrame([("not a url",), ("http://h/",)], "url string")
    best = FR.seed_frontier(seeds).collect()
    assert {(r.url, r.priority, r.depth, r.status, r.context.importance) for r in best} == {
        ("not a url", 100, 0, "pending", 1.0), ("http://h/", 100, 0, "pending", 1.0)
    }
    assert {(r.priority, r.context) for r in FR.seed_frontier(seeds, priority=0).collect()} == {
        (0, None)
    }


def test_merge_keeps_the_first_and_raises_the_priority(spark):
    old = _rows(spark, [("a", 40, 1, "p", 1, 1, "pending"), ("b", 90, 1, "p", 1, 1, "completed")])
    new = _rows(spark, [
        ("a", 70, 3, "q", 9, 2, "pending"), ("b", 10, 3, "q", 9, 2, "pending"),
        ("c", 5, 2, "z", 9, 2, "pending"), ("c", 50, 2, "y", 9, 2, "pending"),
    ])
    assert _plain(FR.add_to_frontier(old, new)) == {
        ("a", 70, 1, "p", 1, "pending"), ("b", 90, 1, "p", 1, "completed"),
        ("c", 50, 2, "y", 2, "pending"),
    }


def test_merge_is_idempotent_and_order_free(spark):
    rng = random.Random(1)
    rows = [
        ("hub" if rng.random() < 0.3 else f"u{rng.randint(0, 60)}", rng.randint(1, 100),
         rng.randint(0, 4), f"p{i}", i, i, "pending")
        for i in range(400)
    ]
    empty = _rows(spark, [])
    once = FR.add_to_frontier(empty, _rows(spark, rows))
    expected = _plain(once)
    rng.shuffle(rows)
    assert _plain(FR.add_to_frontier(empty, _rows(spark, rows).repartition(5))) == expected
    assert _plain(FR.add_to_frontier(once, _rows(spark, rows))) == expected
    rows.sort(key=lambda r: r[5])  # what was merged first is first
    half = FR.add_to_frontier(empty, _rows(spark, rows[:200]))
    assert _plain(FR.add_to_frontier(half, _rows(spark, rows[200:]))) == expected
    best = {}
    for r in rows:
        best[r[0]] = max(best.get(r[0], 0), r[1])
    assert {(u, p) for u, p, *_ in expected} == set(best.items())


def test_merge_combines_repeats_before_the_shuffle(spark):
    rows = _rows(spark, [("a", 1, 0, None, 0, 0, "pending")])
    plan = FR.add_to_frontier(rows, rows)._jdf.queryExecution().executedPlan().treeString()
    assert plan.index("partial_max") > plan.index("Exchange hashpartitioning(url")


@pytest.fixture
def pending(spark):
    rng = random.Random(2)
    return [
        (f"u{i:04d}", rng.randint(1, 9), rng.randint(0, 3), None, rng.randint(0, 20), 0,
         rng.choice(["pending", "pending", "completed"]))
        for i in range(1000)
    ]


def _best(rows, k):
    left = sorted((r for r in rows if r[6] == "pending"), key=lambda r: (-r[1], r[4], r[0]))
    return [r[0] for r in left[:k]]


@pytest.mark.parametrize("k", [0, 1, 37, 400, 5000])
def test_next_urls(spark, pending, k):
    got = FR.next_urls(_rows(spark, pending), k).collect()
    assert sorted(r.url for r in got) == sorted(_best(pending, k))


def _shape(df):
    """Operators of the plan, without literals and ids."""
    plan = df._jdf.queryExecution().executedPlan().treeString()
    return re.findall(r"[A-Z]\w+(?=[ (\[])", re.sub(r"\[.*|file:.*", "", plan))


def test_the_plan_does_not_depend_on_k(spark, pending):
    rows = _rows(spark, pending)
    small, large = FR.next_urls(rows, 3), FR.next_urls(rows, 1_000_000)
    assert _shape(small) == _shape(large)
    assert "TakeOrdered" not in str(_shape(large))


def test_existing_rows_win_whatever_their_seq(spark):
    old = _rows(spark, [("a", 10, 3, "p", 9, 7, "completed")])
    new = _rows(spark, [("a", 30, 1, "q", 1, 1, "pending"), ("b", 5, 1, "q", 1, 1, "pending")])
    got = {r.url: r for r in FR.add_to_frontier(old, new).collect()}
    assert (got["a"].priority, got["a"].depth, got["a"].status) == (30, 3, "completed")
    assert (got["a"].parent_url, got["a"].seq, got["b"].status) == ("p", 7, "pending")


def test_mark_processed(spark):
    rows = _rows(spark, [("a", 1, 0, None, 0, 0, "pending"), ("b", 1, 0, None, 0, 0, "pending")])
    done = spark.createDataFrame([("a",), ("a",), ("z",)], "url string")
    got = {(r.url, r.status) for r in FR.mark_processed(rows, done).collect()}
    assert got == {("a", "completed"), ("b", "pending")}


def test_depth_crawled_and_visited(spark):
    rows = _rows(spark, [(f"u{i}", 1, i, None, 0, 0, "pending") for i in range(5)])
    pages = spark.createDataFrame([("u1",), ("u3",)], "url string")
    urls = lambda df: sorted(r.url for r in df.collect())
    assert urls(FR.within_depth(rows, 2)) == ["u0", "u1", "u2"]
    assert urls(FR.drop_crawled(rows, pages)) == ["u0", "u2", "u4"]
    assert urls(FR.already_crawled(rows, pages)) == ["u1", "u3"]
    links = spark.createDataFrame([("u1",), ("n",), ("n",), ("u1#x",)], "url string")
    assert urls(FR.drop_visited(links, pages)) == ["n", "u1#x"]


def test_frontier_rows(spark):
    links = spark.createDataFrame([("u", 5, 1, "p", "pending")],
                                  "url string, priority int, depth int, parent_url string, "
                                  "status string").withColumn("context", F.lit(None))
    rows = FR.frontier_rows(links, F.lit(4), F.lit("2024-01-01"))
    assert rows.schema == FRONTIER or rows.schema.fieldNames() == FRONTIER.fieldNames()
    assert rows.first().seq == 4
