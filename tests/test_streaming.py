import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from linkloom.operators.content import analyze_content
from linkloom.operators.frontier import add_to_frontier, frontier_rows
from linkloom.operators.links import extract_scored_links
from linkloom.operators.pages import page_rows
from linkloom.plans.reports import crawl_stats
from linkloom.schemas import FRONTIER
from linkloom.sources.captures import captured_pages
from linkloom.streaming import streams

PAGES = "/root/testdata/sf0.001/pages.parquet"
DOCUMENTS = "/root/testdata/sf0.001/documents.parquet"


@pytest.fixture
def split(spark, tmp_path):
    """A table written as several files, read back as a batch and as a stream of one per batch."""

    def run(df, files=4):
        path = str(tmp_path / "input")
        df.repartition(files).write.mode("append").parquet(path)
        batch = spark.read.parquet(path)
        stream = (
            spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(path)
        )
        return batch, stream

    return run


def _finish(running):
    running.awaitTermination()
    assert running.exception() is None


def _rows(df):
    return sorted(json.dumps(r.asDict(True), default=str, sort_keys=True) for r in df.collect())


def test_scores_equal_batch_and_replay_changes_nothing(spark, split, tmp_path):
    batch, stream = split(captured_pages(spark.read.parquet(PAGES)))
    root = str(tmp_path / "store")
    _finish(streams.stream_score(stream, root, str(tmp_path / "checkpoint")))
    expected = page_rows(analyze_content(batch))
    expected = expected.drop("crawled_at")
    stored = streams.read_scored(spark, root).select(*expected.columns)
    assert _rows(stored) == _rows(expected)
    # A new run with a fresh checkpoint replays every batch id over its own directory.
    _finish(streams.stream_score(stream, root, str(tmp_path / "again")))
    assert _rows(streams.read_scored(spark, root).select(*expected.columns)) == _rows(expected)


def test_recaptured_pages_keep_their_origin(spark, tmp_path):
    root, path = str(tmp_path / "store"), str(tmp_path / "input")
    schema = "page_id long, url string, html string, depth int, parent_url string"

    def load(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        stream = captured_pages(spark.readStream.schema(schema).parquet(path))
        _finish(streams.stream_score(stream, root, str(tmp_path / "checkpoint")))
        return {
            r.url: (r.page_id, r.title, r.depth, r.parent_url)
            for r in streams.read_scored(spark, root).collect()
        }

    load((1, "a", "<title>old</title>", 0, "p"), (2, "b", "<title>b</title>", 0, "p"))
    expected = {"a": (1, "new", 0, "p"), "b": (2, "b", 0, "p")}
    assert load((3, "a", "<title>new</title>", 5, "q")) == expected
    streams.compact(spark, root, streams.read_scored)
    expected["c"] = (4, "c", 1, "a")
    expected["b"] = (2, "b2", 0, "p")
    assert load(
        (4, "c", "<title>c</title>", 1, "a"), (5, "b", "<title>b2</title>", 9, "z")
    ) == expected


def test_dedup_keeps_one_copy_per_body(spark, split, tmp_path):
    documents = spark.read.parquet(DOCUMENTS).select(F.col("text").alias("html"), "doc_id")
    batch, stream = split(documents)
    out = str(tmp_path / "out")
    running = (
        streams.stream_dedup(stream).select("hash", "doc_id").writeStream.format("parquet")
        .option("path", out).option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True).start()
    )
    _finish(running)
    got = [r.hash for r in spark.read.parquet(out).collect()]
    assert len(got) == len(set(got)) == 189
    assert set(got) == {r[0] for r in batch.select(F.md5("html")).distinct().collect()}


def test_bounded_dedup(spark, split, tmp_path):
    t0 = datetime(2024, 1, 1, tzinfo=timezone.utc)
    rows = [("same", t0), ("same", t0 + timedelta(minutes=1)), ("other", t0)]
    _, stream = split(spark.createDataFrame(rows, "html string, captured_at timestamp"), 1)
    out = str(tmp_path / "out")
    _finish(
        streams.stream_dedup(stream, delay="1 hour").writeStream.format("parquet")
        .option("path", out).option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True).start()
    )
    assert spark.read.parquet(out).count() == 2


def test_no_late_copy_passes(spark, tmp_path):
    """A copy is dropped however many batches later it comes, also after the store was compacted; replays add nothing."""
    root, path = str(tmp_path / "store"), str(tmp_path / "input")
    schema = "doc_id long, html string"

    def load(checkpoint, *rows):
        if rows:
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
        _finish(streams.stream_unique(stream, root, str(tmp_path / checkpoint)))
        return sorted(r.doc_id for r in streams.read_unique(spark, root).collect())

    assert load("c", (2, "same"), (1, "same"), (3, "other"), (4, None)) == [1, 3]
    assert load("c", (5, "same"), (6, "new"), (7, "")) == [1, 3, 6, 7]
    assert load("c", (8, "other"), (9, "")) == [1, 3, 6, 7]
    assert load("replay") == [1, 3, 6, 7]
    streams.compact(spark, root, streams.read_unique)
    assert load("c", (10, "same"), (11, "last"), (12, "new")) == [1, 3, 6, 7, 11]
    with pytest.raises(FileNotFoundError):
        streams.read_unique(spark, str(tmp_path / "none"))


def test_unique_bodies_equal_batch(spark, split, tmp_path):
    documents = spark.read.parquet(DOCUMENTS).select(F.col("text").alias("html"), "doc_id")
    batch, stream = split(documents)
    root = str(tmp_path / "store")
    _finish(streams.stream_unique(stream, root, str(tmp_path / "checkpoint")))
    got = [r.hash for r in streams.read_unique(spark, root).collect()]
    assert sorted(got) == sorted(r[0] for r in batch.select(F.md5("html")).distinct().collect())


def test_frontier_equals_batch(spark, split, tmp_path):
    batch, stream = split(captured_pages(spark.read.parquet(PAGES)))
    at = F.lit("2024-01-01").cast("timestamp")
    root = str(tmp_path / "frontier")

    def rows(captures):
        return frontier_rows(extract_scored_links(captures), F.lit(1), at)

    _finish(streams.stream_frontier(rows(stream), root, str(tmp_path / "checkpoint")))
    # The first batch that has a URL decides, and among its rows the smallest.
    log = spark.read.parquet(f"{root}/log").withColumn("seq", F.col("batch_id").cast("long"))
    assert log.select("batch_id").distinct().count() == 4
    expected = _rows(add_to_frontier(spark.createDataFrame([], FRONTIER), log))
    assert {r.url for r in log.collect()} == {r.url for r in rows(batch).collect()}
    assert _rows(streams.read_frontier(spark, root)) == expected
    streams.compact(spark, root, streams.read_frontier)
    assert _rows(streams.read_frontier(spark, root)) == expected
    assert not list((tmp_path / "frontier" / "log").glob("batch_id=*"))


def test_the_first_batch_keeps_a_url(spark, tmp_path):
    root = str(tmp_path / "frontier")

    def load(n, *rows):
        path = str(tmp_path / "input")
        df = spark.createDataFrame(
            [(u, p, d, None, None, 1, s, None) for u, p, d, s in rows], FRONTIER
        )
        df.coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(FRONTIER).parquet(path)
        _finish(streams.stream_frontier(stream, root, str(tmp_path / "checkpoint")))
        return {(r.url, r.priority, r.depth, r.status)
                for r in streams.read_frontier(spark, root).collect()}

    load(0, ("a", 10, 3, "completed"))
    assert load(1, ("a", 20, 1, "pending")) == {("a", 20, 3, "completed")}
    streams.compact(spark, root, streams.read_frontier)
    assert load(2, ("a", 30, 0, "pending")) == {("a", 30, 3, "completed")}


def test_faults_replace_no_page(spark, tmp_path):
    root, path = str(tmp_path / "store"), str(tmp_path / "input")
    schema = "url string, html string, content_type string"

    def load(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        stream = captured_pages(spark.readStream.schema(schema).parquet(path))
        _finish(streams.stream_score(stream, root, str(tmp_path / "checkpoint")))

    load(("a", "<title>good</title>", "text/html"))
    load(("a", None, "text/html"), ("b", "x", "image/png"), ("c", None, None))
    for _ in range(2):
        assert [(r.url, r.title) for r in streams.read_scored(spark, root).collect()] == [("a", "good")]
        assert {(r.url, r.reason) for r in streams.read_faults(spark, root).collect()} == {
            ("a", "fetch_failed"), ("b", "irrelevant_content_type"), ("c", "fetch_failed"),
        }
        streams.compact(spark, root, streams.read_scored)  # faults stay as they are


def test_readers_see_committed_batches_only(spark, tmp_path):
    root = tmp_path / "store"
    assert streams.read_scored(spark, str(root)).count() == 0
    assert streams.read_frontier(spark, str(root)).count() == 0
    rows = page_rows(analyze_content(captured_pages(spark.read.parquet(PAGES))))
    rows.write.parquet(f"{root}/log/batch_id=0")
    rows.withColumn("url", F.concat("url", F.lit("x"))).write.parquet(f"{root}/log/batch_id=1")
    assert streams.read_scored(spark, str(root)).count() == 100
    (root / "log" / "batch_id=1" / "_SUCCESS").unlink()
    assert streams.read_scored(spark, str(root)).count() == 50


def test_dedup_moves_no_page_text(spark):
    captures = spark.read.parquet(DOCUMENTS).select("doc_id", F.col("text").alias("html"))
    kept = streams.stream_dedup(captures)
    assert set(kept.columns) == {"doc_id", "hash", "size"}
    assert "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")


def _outcomes(spark):
    t0 = datetime(2024, 1, 1, tzinfo=timezone.utc)
    kinds = ["processed", "skipped", "error", "processed"]
    rows = [
        ("smart" if i % 2 else "traditional", kinds[i % 4], i, t0 + timedelta(minutes=i))
        for i in range(200)
    ]
    return spark.createDataFrame(rows, "strategy string, outcome string, size long, ts timestamp")


def test_running_counters_equal_batch(spark, split):
    batch, stream = split(_outcomes(spark))
    running = (
        streams.stream_stats(stream).writeStream.format("memory").queryName("counters")
        .outputMode("complete").trigger(availableNow=True).start()
    )
    _finish(running)
    assert _rows(spark.table("counters")) == _rows(crawl_stats(batch))


def test_windowed_counters_close_behind_the_watermark(spark, split):
    batch, stream = split(_outcomes(spark), files=1)
    running = (
        streams.stream_stats(stream, window="1 hour").writeStream.format("memory")
        .queryName("windows").outputMode("append").trigger(availableNow=True).start()
    )
    _finish(running)
    got = spark.table("windows").select("window.start", "strategy", "pages_processed").collect()
    expected = {
        (r["w"].start, r["strategy"], r["n"])
        for r in batch.groupBy(F.window("ts", "1 hour").alias("w"), "strategy")
        .agg(F.count_if(F.col("outcome") == "processed").alias("n")).collect()
    }
    # 200 minutes with a delay of 10: the last of four windows is still open.
    assert {tuple(r) for r in got} < expected
    assert len({r[0] for r in got}) == 3


def test_a_batch_of_captures_is_read_once(spark):
    """Pages and faults come from one scan, and the text of faults is never cut into pieces."""
    captures = spark.createDataFrame(
        [("http://h/a", "<title>t</title>x", "text/html"), ("http://h/b", None, None), ("http://h/c", "<p>x", "image/png")],
        "url string, html string, content_type string",
    ).selectExpr("*", "200 AS status_code", "1L AS load_time_ms", "timestamp'2024-01-01' AS captured_at")
    rows = streams.scored_batch(captures)
    plan = rows._jdf.queryExecution().executedPlan().treeString()
    assert plan.count("Scan ") == 1 and "Exchange" not in plan
    assert {(r.url, r.kind, r.reason, r.title) for r in rows.collect()} == {
        ("http://h/a", "page", None, "t"), ("http://h/b", "fault", "fetch_failed", None),
        ("http://h/c", "fault", "irrelevant_content_type", None),
    }
