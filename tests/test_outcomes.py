import hashlib
import random

from pyspark.sql import functions as F

from linkloom.operators.outcomes import capture_facts, classify_outcomes, drop_irrelevant

SCHEMA = (
    "url string, html string, content_type string, load_time_ms long, captured_at timestamp, "
    "strategy string, depth int, priority int, seq long"
)


def _captures(n=1200, seed=9):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        body = "hot" if i % 3 == 0 else f"body {rng.randint(0, 150)}"
        rows.append((
            "hub" if rng.random() < 0.2 else f"u{rng.randint(0, 700)}",
            None if rng.random() < 0.1 else body,
            rng.choice(["text/html; charset=x", "text/plain", "image/png", None]),
            i, None, "smart", rng.randint(0, 3), rng.randint(1, 5), i,
        ))
    return rows


def _expected(rows, crawled):
    order = lambda r: (r[6], -r[7], r[8], r[0])
    single = {}
    for r in sorted(rows, key=order):
        single.setdefault(r[0], r)
    seen, found = set(), {}
    for r in sorted(single.values(), key=order):
        url, html, kind = r[:3]
        if url in crawled:
            found[url] = ("skipped", "already_crawled")
        elif html is None:
            found[url] = ("error", "fetch_failed")
        elif not kind or not kind.startswith("text/"):
            found[url] = ("skipped", "irrelevant_content_type")
        elif html in seen:
            found[url] = ("skipped", "duplicate_content")
        else:
            seen.add(html)
            found[url] = ("processed", None)
    return found


def test_every_url_has_one_outcome(spark):
    rows = _captures()
    crawled = {f"u{i}" for i in range(0, 700, 7)}
    pages = spark.createDataFrame([(u,) for u in crawled], "url string")
    captures = spark.createDataFrame(rows, SCHEMA).repartition(6)
    got = classify_outcomes(capture_facts(captures), pages).collect()
    assert len(got) == len({r.url for r in got})
    assert {r.url: (r.outcome, r.reason) for r in got} == _expected(rows, crawled)


def test_captures_are_read_once(spark):
    captures = spark.createDataFrame(_captures(50), SCHEMA)
    pages = spark.createDataFrame([("u1",)], "url string")
    plan = classify_outcomes(capture_facts(captures), pages)
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().treeString().split("== Initial Plan ==")[0]
    assert text.count("md5(") == 1 and "ReusedExchange" in text and "Window" not in text


def test_facts(spark):
    (r,) = capture_facts(spark.createDataFrame([("u", "ü")], "url string, html string")).collect()
    assert (r.hash, r.size, r.fetched) == (hashlib.md5("ü".encode()).hexdigest(), 2, True)


def test_irrelevant_types(spark):
    df = spark.createDataFrame([("text/html",), (None,), ("image/png",)], "content_type string")
    assert [r.content_type for r in drop_irrelevant(df).collect()] == ["text/html"]
    assert drop_irrelevant(df.withColumn("x", F.lit(1))).columns == ["content_type", "x"]


def test_tables_of_the_past_are_narrowed_to_the_batch(spark, tmp_path):
    """A large page store and a large table of hashes are scanned, but only keys of the batch are shuffled."""
    n = 200_000
    spark.range(n).select(F.concat(F.lit("u"), "id").alias("url")).write.parquet(f"{tmp_path}/pages")
    spark.range(n).select(F.md5(F.concat(F.lit("body "), "id")).alias("hash")).write.parquet(f"{tmp_path}/seen")
    rows = [(f"u{n + i}" if i % 4 else f"u{i}", f"body {i}" if i % 3 == 0 else f"new {i}", "text/html", i, None, "smart", 0, 1, i) for i in range(300)]
    capture_facts(spark.createDataFrame(rows, SCHEMA)).write.parquet(f"{tmp_path}/facts")  # as rounds do: Spark knows the size
    plan = classify_outcomes(spark.read.parquet(f"{tmp_path}/facts"), spark.read.parquet(f"{tmp_path}/pages"), spark.read.parquet(f"{tmp_path}/seen"))
    got = {r.url: r.reason for r in plan.collect()}
    for url, html, *_ in rows:
        assert got[url] == ("already_crawled" if int(url[1:]) < n else "duplicate_content" if html.startswith("body") else None)
    assert max(_shuffled_rows(plan)) <= len(rows)


def _shuffled_rows(df):
    """Rows written by each shuffle of the plan that ran."""
    plan, found = [df._jdf.queryExecution().executedPlan()], []
    while plan:
        node = plan.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            plan.append(node.executedPlan())
            continue
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            plan.append(node.plan())
            continue
        if node.getClass().getSimpleName() == "ShuffleExchangeExec":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        plan += [children.apply(i) for i in range(children.size())]
    return found
