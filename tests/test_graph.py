import random
from collections import defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from linkloom.operators.frontier import seed_frontier
from linkloom.plans import expand
from linkloom.plans.bfs import bfs_depths
from linkloom.plans.expand import CrawlState, expand_frontier, prepare_site
from linkloom.schemas import PAGES
from verification.queries import QUERIES


def _levels(edges, seeds, max_depth):
    out = defaultdict(set)
    for s, d in edges:
        out[s].add(d)
    found = {s: (0, None) for s in seeds}
    level = set(seeds)
    for depth in range(1, max_depth + 1):
        parents = {}
        for s in sorted(level):
            for d in out[s]:
                if d not in found:
                    parents[d] = min(parents.get(d, s), s)
        found |= {d: (depth, p) for d, p in parents.items()}
        level = set(parents)
    return {(u, *v) for u, v in found.items()}


@pytest.mark.parametrize("max_depth", [0, 1, 3, 10])
def test_bfs_against_a_loop(spark, max_depth):
    rng = random.Random(6)
    nodes = [f"n{i}" for i in range(150)]
    edges = [(rng.choice(nodes), rng.choice(nodes)) for _ in range(250)]
    # One page holds a third of all links, one target receives many.
    edges += [("n0", rng.choice(nodes)) for _ in range(150)] + [(n, "n1") for n in nodes[:50]]
    seeds = ["n5", "n77", "absent"]
    df = spark.createDataFrame(edges, "src string, dst string").repartition(5)
    start = spark.createDataFrame([(s,) for s in seeds], "url string")
    got = bfs_depths(df, start, max_depth).collect()
    assert {tuple(r) for r in got} == _levels(edges, seeds, max_depth)
    assert len(got) == len({r.url for r in got})
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("edges_")]


def test_bfs_shuffles_neither_edges_nor_visited(spark):
    """A level reads both bucketed tables in place: only the level and its targets are exchanged."""
    from linkloom.plans import bfs
    from linkloom.session import scratch_path

    edges = spark.createDataFrame(
        [(f"a{i}", f"b{i}", 0) for i in range(50)], "src string, dst string, salt int"
    )
    visited = spark.createDataFrame([("a1", 0, None)], "url string, depth int, parent_url string")
    hubs = spark.createDataFrame([("a1", 2)], "src string, shares long")
    names = ("edges_t", "visited_t")
    bfs._bucketed(edges, names[0], scratch_path(spark, "e"), 8, ["src", "salt"])
    bfs._bucketed(visited, names[1], scratch_path(spark, "v"), 8, ["url"])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        level = bfs._next_level(
            spark.table(names[0]), spark.table(names[1]), hubs, 1
        )
        plan = level._jdf.queryExecution().executedPlan().treeString()
        assert plan.count("Exchange hashpartitioning") == 3  # the level's sources, its targets, the few hubs
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        for name in names:
            spark.sql(f"DROP TABLE {name}")


def test_only_hubs_are_split(spark):
    """A page with half of all links is spread over shares of bounded size; all others stay whole."""
    from linkloom.plans import bfs

    rng = random.Random(4)
    edges = [("hub", f"n{i}") for i in range(2000)] + [(f"n{rng.randrange(500)}", f"n{rng.randrange(2000)}") for _ in range(2000)]
    df = spark.createDataFrame(edges, "src string, dst string")
    (hub,) = bfs.hub_shares(df, 100).collect()
    assert (hub.src, hub.shares) == ("hub", 20)
    salted = df.join(bfs.hub_shares(df, 100), "src", "left").withColumn(
        "salt", F.pmod(F.xxhash64("dst"), F.coalesce("shares", F.lit(1)))
    )
    sizes = sorted(r["count"] for r in salted.groupBy("src", "salt").count().collect())
    assert sizes[-1] < 150 and salted.where("shares is null and salt != 0").count() == 0
    start = spark.createDataFrame([("hub",), ("n1",)], "url string")
    for share in (100, 3, 10**6):
        got = bfs_depths(df, start, 4, share_edges=share).collect()
        assert {tuple(r) for r in got} == _levels(edges, ["hub", "n1"], 4)


def test_bfs_leaves_no_edge_files(spark):
    folder = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    edges = spark.createDataFrame([("a", "b"), ("b", "c")], "src string, dst string")
    start = spark.createDataFrame([("a",)], "url string")
    before = {p.name for p in folder.iterdir()}
    assert bfs_depths(edges, start, 5, buckets=3).count() == 3
    left = {p.name for p in folder.iterdir()} - before
    assert all(name.startswith("bfs-visited") for name in left)
    broken = edges.selectExpr("src", "raise_error('no') AS dst")
    with pytest.raises(Exception, match="no"):
        bfs_depths(broken, start, 5).count()
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("visited_")]


SITE = {
    "http://h/": '<a href="/news/a">news a</a><a href="/b">b</a><a href="/missing">m</a>',
    "http://h/news/a": '<a href="/c">c</a><a href="/">home</a>',
    "http://h/b": '<a href="/c">research c</a>',
    "http://h/c": '<a href="/d">d</a>',
    "http://h/d": "same",
    "http://h/e": "same",
}


def _site(spark):
    rows = [(u, h, "text/html") for u, h in SITE.items()]
    rows.append(("http://h/gone", None, None))
    return spark.createDataFrame(rows, "url string, html string, content_type string").selectExpr(
        "*", "200 AS status_code", "cast(null AS bigint) AS load_time_ms",
        "cast(null AS timestamp) AS captured_at",
    )


def _crawl(spark, seeds, rounds=10, k=2, max_depth=5, stored=()):
    frontier = seed_frontier(spark.createDataFrame([(s,) for s in seeds], "url string"))
    pages = spark.createDataFrame([(1, u) for u in stored], "page_id long, url string")
    pages = pages.select(
        *(F.col(f.name) if f.name in pages.columns else F.lit(None).cast(f.dataType).alias(f.name)
          for f in PAGES.fields if f.name != "content")
    )
    return _rounds(spark, CrawlState(frontier, pages), rounds, k, max_depth)


def _rounds(spark, state, rounds, k, max_depth=5):
    """Rounds until the batch is empty, with the outcomes of all."""
    site, at = prepare_site(_site(spark)), F.lit("2024-01-01").cast("timestamp")
    collected = None
    for number in range(1, rounds + 1):
        state = expand_frontier(state, site, k, max_depth, F.lit(number), at)
        if state.outcomes.isEmpty():
            break
        tagged = state.outcomes.withColumn("round", F.lit(number))
        collected = tagged if collected is None else collected.unionByName(tagged)
    return CrawlState(state.frontier, state.pages, collected, state.seen)


def _outcomes(state):
    return {(r["round"], r.url, r.outcome, r.reason) for r in state.outcomes.collect()}


def test_rounds_take_the_best_first(spark):
    state = _crawl(spark, ["http://h/"], k=1)
    assert _outcomes(state) == {
        (1, "http://h/", "processed", None),
        (2, "http://h/news/a", "processed", None),
        (3, "http://h/b", "processed", None),
        # Found again by b with a keyword in its anchor, hence ahead of the missing page.
        (4, "http://h/c", "processed", None),
        (5, "http://h/d", "processed", None),
        (6, "http://h/missing", "error", "not_captured"),
    }
    frontier = {r.url: r for r in state.frontier.collect()}
    assert {r.status for r in frontier.values()} == {"completed"}
    assert frontier["http://h/c"].parent_url == "http://h/news/a"
    assert frontier["http://h/c"].depth == 2 and frontier["http://h/c"].priority == 80
    assert {r.url for r in state.pages.collect()} == set(SITE) - {"http://h/e"}


def test_stored_failed_and_duplicate_pages(spark):
    seeds = ["http://h/c", "http://h/d", "http://h/e", "http://h/gone"]
    state = _crawl(spark, seeds, rounds=1, k=10, stored=["http://h/c"])
    assert _outcomes(state) == {
        (1, "http://h/c", "skipped", "already_crawled"),
        (1, "http://h/d", "processed", None),
        (1, "http://h/e", "skipped", "duplicate_content"),
        (1, "http://h/gone", "error", "fetch_failed"),
    }
    assert {r.url for r in state.pages.collect()} == {"http://h/c", "http://h/d"}
    # A skipped page adds no links.
    assert state.frontier.count() == 4


def test_a_body_of_an_earlier_round_is_a_duplicate(spark):
    state = _crawl(spark, ["http://h/d", "http://h/e"], k=1)
    assert _outcomes(state) == {
        (1, "http://h/d", "processed", None),
        (2, "http://h/e", "skipped", "duplicate_content"),
    }


def test_depth_limit(spark):
    state = _crawl(spark, ["http://h/"], max_depth=1)
    assert {r.url for r in state.pages.collect()} == {"http://h/", "http://h/news/a", "http://h/b"}
    assert state.frontier.filter("depth > 1").count() == 0


def test_empty_frontier_stops(spark):
    state = _crawl(spark, ["http://h/d"], rounds=3)
    assert _outcomes(state) == {(1, "http://h/d", "processed", None)}


def _bytes(path):
    return sum(f.stat().st_size for f in path.rglob("*.parquet"))


def test_rounds_write_their_batch_only(spark):
    """What a round adds to the shared folder follows the batch, not the frontier; nothing else stays."""
    folder = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    site, at = prepare_site(_site(spark)), F.lit("2024-01-01").cast("timestamp")
    written = []
    for extra in (10, 20_000):
        seeds = spark.createDataFrame([("http://h/",)] + [(f"http://x/{i}",) for i in range(extra)], "url string")
        waiting = seed_frontier(seeds).withColumn("priority", F.when(F.col("url") == "http://h/", 100).otherwise(1))
        frontier = waiting.select(*(F.col(f.name).cast(f.dataType) for f in waiting.schema.fields))
        pages = spark.createDataFrame([], PAGES).drop("content")
        before = set(folder.iterdir())
        state = expand_frontier(CrawlState(frontier, pages), site, 1, 5, F.lit(1), at)
        assert state.outcomes.count() == 1 and state.frontier.count() == extra + 4
        (left,) = set(folder.iterdir()) - before
        assert sorted(p.name for p in left.iterdir()) == ["batch", "links", "outcomes", "pages"]
        written.append(_bytes(left))
    assert written[1] < 1.2 * written[0]


def test_logs_are_merged_now_and_then(spark, monkeypatch):
    folder = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    whole = _crawl(spark, ["http://h/"], rounds=3, k=1)
    expected = [sorted(map(tuple, df.collect()), key=str) for df in (whole.frontier, whole.pages, whole.seen)]
    monkeypatch.setattr(expand, "MERGE_ROUNDS", 2)
    before = set(folder.iterdir())
    state = _crawl(spark, ["http://h/"], rounds=3, k=1)
    assert _outcomes(state) == _outcomes(whole)
    assert [sorted(map(tuple, df.collect()), key=str) for df in (state.frontier, state.pages, state.seen)] == expected
    names = [p.name.rpartition("-")[0] for p in set(folder.iterdir()) - before]
    assert sorted(n for n in names if n.startswith("merged")) == ["merged-frontier", "merged-pages", "merged-seen"]


def test_rounds_may_go_on_later(spark):
    """Numbering starts anew with every call; a completed URL keeps its state all the same."""
    state = _crawl(spark, ["http://h/"], rounds=3, k=1)
    before = {r.url: r for r in state.frontier.collect()}
    done = {u for u, r in before.items() if r.status == "completed"}
    state = _rounds(spark, state, rounds=3, k=1)
    after = {r.url: r for r in state.frontier.collect()}
    for url in done:
        assert after[url].asDict() | {"priority": 0} == before[url].asDict() | {"priority": 0}
    assert {u for u, r in after.items() if r.status == "completed"} > done


def test_outcomes_of_links_found_in_earlier_rounds(spark, tmp_path):
    """Page 0 links to the others, and to URLs without a capture, which only later rounds decide."""
    html = "<title>t</title>" + "".join(f'<a href="http://h/found/{i}">x</a>' for i in range(3))
    rows = [(i, f"http://h/p/{i}", html if i == 0 else f"page {i}") for i in range(4)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    found = QUERIES["expand_frontier_outcomes"](spark, str(tmp_path)).collect()
    assert {r.round for r in found} == {1, 2, 3}
    by_url = {r.url: (r.outcome, r.reason) for r in found}
    # Half as many URLs as pages in each round, none twice: the four pages, then two of the links.
    assert len(found) == len(by_url) == 6
    assert {by_url[f"http://h/p/{i}"] for i in range(4)} == {("processed", None)}
    assert [by_url[u] for u in by_url if "found" in u] == [("error", "not_captured")] * 2
