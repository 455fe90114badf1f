import random
from collections import defaultdict

from linkloom.operators.dedup import (
    drop_duplicate_content, similar_by_hash, similar_content,
)


def _pages(n=600, seed=3):
    """A third of all pages share one hash; the rest are in groups of one to nine."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        h = "hot" if i % 3 == 0 else f"h{rng.randint(0, n // 8)}"
        rows.append((i, f"http://h/{i}", f"t{i}", h))
    rng.shuffle(rows)
    return rows


def test_similar_content_against_brute_force(spark):
    rows = _pages()
    groups = defaultdict(list)
    for page_id, url, title, h in sorted(rows):
        groups[h].append((page_id, url, title))
    expected = set()
    for page_id, _, _, h in rows:
        others = [m for m in groups[h] if m[0] != page_id][:5]
        expected |= {(page_id, rank, *m, h) for rank, m in enumerate(others, start=1)}
    pages = spark.createDataFrame(rows, "page_id long, url string, title string, hash string")
    got = similar_content(pages.repartition(7)).collect()
    assert len(got) == len(expected) and {tuple(r) for r in got} == expected


def test_similar_content_cuts_groups_before_the_shuffle(spark):
    pages = spark.createDataFrame(_pages(), "page_id long, url string, title string, hash string")
    plan = similar_content(pages)._jdf.queryExecution().executedPlan().treeString()
    assert "row_number(), 6, Partial" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_similar_by_hash(spark):
    pages = spark.createDataFrame(_pages(), "page_id long, url string, title string, hash string")
    assert [r.page_id for r in similar_by_hash(pages, "hot").collect()] == [0, 3, 6, 9, 12]
    assert similar_by_hash(pages, "absent").count() == 0


def _captures(n=900, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        h = "hot" if i % 3 == 0 else f"h{rng.randint(0, n // 5)}"
        rows.append((h, rng.randint(0, 3), rng.randint(1, 5), rng.randint(0, 50), f"u{i}", i))
    return rows


SCHEMA = "hash string, depth int, priority int, seq long, url string, size int"


def _first(rows):
    return min(rows, key=lambda r: (r[1], -r[2], r[3], r[4]))


def test_first_copy_against_brute_force(spark):
    rows = _captures()
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]].append(r)
    expected = {_first(g) for g in groups.values()}
    captures = spark.createDataFrame(rows, SCHEMA).repartition(6)
    assert {tuple(r) for r in drop_duplicate_content(captures).collect()} == expected


def test_similar_content_has_one_plan(spark):
    pages = spark.range(100).selectExpr(
        "id AS page_id", "concat('u', id) AS url", "'t' AS title", "md5(string(id % 7)) AS hash"
    )
    few, many = similar_content(pages, 5), similar_content(pages, 5000)
    plans = [p._jdf.queryExecution().executedPlan().treeString() for p in (few, many)]
    assert len({p.count("Exchange") for p in plans}) == 1
    counts = [p.groupBy("probe_id").count().agg({"count": "max"}).first()[0] for p in (few, many)]
    assert counts == [5, 14]
