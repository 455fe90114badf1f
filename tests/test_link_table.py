"""The link table over several arrivals against the links of all pages at once."""

from pathlib import Path

from linkloom.operators.links import page_links
from linkloom.sources.link_table import add_arrival, read_links

SCHEMA = "page_id long, url string, html string"
PAGES = [
    (1, "http://h/a", '<a href="/b">b</a><a href="/c" rel=x>c</a><a href="/a">self</a><a href="/never">n</a>'),
    (2, "http://h/b", '<a href="/a">a</a><a href="/c">c</a>'),
    (3, "http://h/c", '<a href="/a">a</a>' + '<a href="/d">d</a>' * 3),
    (4, "http://h/d", "no links"),
]


def _rows(df):
    return sorted(((r.source_id, r.pos, r.url, r.target_id, r.anchor, r.rel) for r in df.collect()), key=str)


def test_arrivals_equal_one_pass(spark, tmp_path):
    root, pages = str(tmp_path / "links"), spark.createDataFrame(PAGES, SCHEMA)
    assert read_links(spark, root).count() == 0
    for arrival, ids in enumerate(((1,), (3, 4), (2,))):
        add_arrival(pages.where(pages.page_id.isin(*ids)), root, arrival)
        seen = [i for got in ((1,), (3, 4), (2,))[: arrival + 1] for i in got]
        assert _rows(read_links(spark, root)) == _rows(page_links(pages.where(pages.page_id.isin(*seen))))


def test_repeated_and_broken_arrivals(spark, tmp_path):
    root, pages = str(tmp_path / "links"), spark.createDataFrame(PAGES, SCHEMA)
    add_arrival(pages.where("page_id < 3"), root, 0)
    first = _rows(read_links(spark, root))
    add_arrival(pages, root, 0)  # counts already
    assert _rows(read_links(spark, root)) == first
    add_arrival(pages.where("page_id >= 2"), root, 1)  # page 2 is known
    whole = _rows(page_links(pages))
    assert _rows(read_links(spark, root)) == whole
    (Path(root) / "links" / "arrival=1" / "_SUCCESS").unlink()
    assert _rows(read_links(spark, root)) == first
    add_arrival(pages.where("page_id >= 3"), root, 1)
    assert _rows(read_links(spark, root)) == whole


def test_copies_and_empty_arrivals(spark, tmp_path):
    root = str(tmp_path / "links")
    copies = spark.createDataFrame([(9, "http://h/a", '<a href="/b">late</a>'), PAGES[0]], SCHEMA)
    add_arrival(copies, root, 0)
    add_arrival(copies.limit(0), root, 5)
    add_arrival(spark.createDataFrame(PAGES[1:], SCHEMA), root, 6)
    assert _rows(read_links(spark, root)) == _rows(page_links(spark.createDataFrame(PAGES, SCHEMA)))
