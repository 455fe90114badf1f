import random
from datetime import datetime, timezone

import pytest

from linkloom.operators.pages import fold_pages, upsert_pages
from linkloom.schemas import PAGES
from linkloom.sources.captures import captured_pages
from linkloom.sources.tables import current_version, read_table, write_table


def _at(seconds):
    return datetime.fromtimestamp(seconds, timezone.utc)


def _pages(spark, rows):
    """Page rows from (id, url, title, depth, parent, seconds)."""
    full = [
        (i, u, title, f"<p>{title}", 200, "text/html", len(title), 1, depth, parent, _at(at),
         title, 0.5, 0.5, 0.5)
        for i, u, title, depth, parent, at in rows
    ]
    return spark.createDataFrame(full, PAGES)


def _plain(df):
    return {
        (r.page_id, r.url, r.title, r.depth, r.parent_url, r.content) for r in df.collect()
    }


def test_upsert_replaces_all_but_the_origin(spark):
    old = _pages(spark, [(1, "a", "old", 0, "p", 1), (2, "b", "kept", 1, "p", 1)])
    new = _pages(spark, [
        (9, "a", "newer", 5, "q", 5), (8, "a", "new", 4, "q", 3), (7, "c", "first", 2, "r", 2),
        (6, "c", "last", 3, "s", 4),
    ])
    merged = upsert_pages(old, new)
    assert merged.columns == PAGES.fieldNames()
    assert _plain(merged) == {
        (1, "a", "newer", 0, "p", "<p>newer"), (2, "b", "kept", 1, "p", "<p>kept"),
        (7, "c", "last", 2, "r", "<p>last"),
    }
    assert _plain(upsert_pages(merged, new)) == _plain(merged)


def test_upsert_agrees_with_a_loop_and_ignores_order(spark):
    rng = random.Random(4)
    rows = [
        (i, "hub" if rng.random() < 0.3 else f"u{rng.randint(0, 80)}", f"t{i}", i % 5, f"p{i}", i)
        for i in range(500)
    ]
    store = {}
    for i, url, title, depth, parent, _ in rows:
        first = store.get(url, (i, depth, parent))[:3]
        store[url] = (*first, title)
    expected = {(i, u, t, d, p, f"<p>{t}") for u, (i, d, p, t) in store.items()}
    old, new = rows[:150], rows[150:]
    rng.shuffle(new)
    existing = upsert_pages(_pages(spark, []), _pages(spark, old))
    assert _plain(upsert_pages(existing, _pages(spark, new).repartition(6))) == expected
    assert _plain(fold_pages(_pages(spark, rows).repartition(3), "crawled_at")) == expected


def test_upsert_combines_copies_before_the_shuffle(spark):
    rows = _pages(spark, [(1, "a", "x", 0, "p", 1)])
    plan = upsert_pages(rows, rows)._jdf.queryExecution().executedPlan().treeString()
    assert "partial_max" in plan and "FullOuter" in plan


def test_table_versions(spark, tmp_path):
    root = str(tmp_path / "pages")
    with pytest.raises(FileNotFoundError):
        read_table(spark, root)
    assert read_table(spark, root, PAGES).count() == 0
    df = _pages(spark, [(1, "a", "x", 0, "p", 1)])
    assert write_table(df, root) == 1
    assert write_table(df.union(df), root) == 2
    assert read_table(spark, root, PAGES).count() == 2
    assert read_table(spark, root, PAGES, version=1).count() == 1
    # A version without its commit mark, as a lost writer leaves it, does not count.
    (tmp_path / "pages" / "version=3").mkdir()
    assert current_version(spark, root) == 2
    assert write_table(df, root, version=2) == 2
    assert read_table(spark, root).count() == 1


def test_partitioned_table_prunes(spark, tmp_path):
    root = str(tmp_path / "frontier")
    df = spark.createDataFrame([("a", "pending"), ("b", "completed")], "url string, status string")
    write_table(df, root, partition_by=["status"])
    plan = read_table(spark, root).filter("status = 'pending'")
    assert [r.url for r in plan.collect()] == ["a"]
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(status" in text


def test_captured_pages_fills_defaults_and_keeps_values(spark):
    bare = captured_pages(spark.createDataFrame([("u", "h")], "url string, html string")).first()
    assert (bare.status_code, bare.content_type, bare.load_time_ms) == (200, "text/html", None)
    full = spark.createDataFrame(
        [(7, "u", "h", 404, None, 12)],
        "page_id long, url string, html string, status_code int, content_type string, "
        "load_time_ms long",
    )
    row = captured_pages(full).first()
    assert (row.page_id, row.status_code, row.content_type, row.load_time_ms) == (7, 404, None, 12)


def test_scan_reads_only_the_needed_columns(spark, tmp_path):
    path = str(tmp_path / "captures")
    _pages(spark, [(1, "a", "x", 0, "p", 1)]).write.parquet(path)
    plan = spark.read.parquet(path).select("url").join(
        spark.read.parquet(path).select("url", "hash"), "url"
    )
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "content" not in text.replace("content_", "")
