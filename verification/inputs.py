"""Inputs the queries derive from the given tables. Every one covers its whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from linkloom.sources.captures import captured_pages


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return captured_pages(table(spark, sf_dir, "pages"))


def document_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as stored pages; they hold exact copies, which pages do not."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("page_id"),
        document_url().alias("url"),
        F.concat(F.col("source"), F.lit(" "), F.col("lang")).alias("title"),
        F.md5("text").alias("hash"),
    )


def document_url() -> Column:
    return F.concat(
        F.lit("http://"), F.col("source"), F.lit(".example.com/"), F.col("lang"), F.lit("/"),
        F.col("doc_id").cast("string"),
    )


def page_content_type() -> Column:
    return (
        F.when(F.contains("url", F.lit("utm_source")), "application/json")
        .when(F.contains("url", F.lit(".html")), "application/xhtml+xml")
        .when(~F.contains("url", F.lit("#top")), "text/html; charset=utf-8")
    )


def strategy() -> Column:
    return F.when(F.startswith("url", F.lit("https")), "smart").otherwise("traditional")


def crawled_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URLs that count as stored already: those of pages with a query string."""
    return table(spark, sf_dir, "pages").filter(F.contains("url", F.lit("?"))).select("url")


def mixed_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures with every fault: pages, a second capture of each without its fragment (some
    repeat a URL, some a body), and documents, of which the toxic ones failed to load."""
    pages = table(spark, sf_dir, "pages")
    first = pages.select(
        "url", "html", page_content_type().alias("content_type"), F.lit(0).alias("depth"),
        F.lit(50).alias("priority"), F.col("page_id").alias("seq"),
    )
    bare = F.substring_index("url", "#", 1)
    again = pages.select(
        bare.alias("url"), "html", F.lit("text/html").alias("content_type"),
        F.lit(1).alias("depth"), F.lit(60).alias("priority"),
        (F.col("page_id") + 1_000_000_000).alias("seq"),
    )
    toxic = table(spark, sf_dir, "labels").filter("toxic = 1").select("doc_id", "toxic")
    documents = table(spark, sf_dir, "documents").join(toxic, "doc_id", "left").select(
        document_url().alias("url"),
        F.when(F.col("toxic").isNull(), F.col("text")).alias("html"),
        F.when(F.col("lang") == "de", "application/pdf").otherwise("text/plain")
        .alias("content_type"),
        F.lit(2).alias("depth"),
        (F.col("n_chars") % 100 + 1).cast("int").alias("priority"),
        (F.col("doc_id") + 2_000_000_000).alias("seq"),
    )
    rows = first.unionByName(again).unionByName(documents)
    return rows.withColumns(
        {
            "strategy": strategy(),
            "load_time_ms": F.col("seq") % 1000,
            "captured_at": F.timestamp_seconds(F.col("seq") % 86400),
        }
    )


def event_outcomes(events: DataFrame) -> DataFrame:
    """Events as an outcome log."""
    kind = F.col("event_type")
    return events.select(
        F.concat(F.lit("http://h"), F.col("user_id").cast("string"), F.lit(".example.com/"),
                 F.col("event_id").cast("string")).alias("url"),
        F.when(F.col("user_id") % 2 == 0, "traditional").otherwise("smart").alias("strategy"),
        F.when(kind == "error", "error").when(kind.isin("view", "signup"), "skipped")
        .otherwise("processed").alias("outcome"),
        F.when(kind == "view", "already_crawled").when(kind == "signup", "duplicate_content")
        .alias("reason"),
        F.floor(F.col("value") * 1024).cast("long").alias("size"),
        F.floor(F.col("value") * 10).cast("long").alias("load_time_ms"),
        F.col("ts").cast("timestamp").alias("ts"),
    )


def page_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Link graph over the captured pages with cycles, self loops and shared targets."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    n = pages.count()
    i = F.col("page_id")
    ids = pages.select(
        F.col("url").alias("src"),
        F.explode(F.array((2 * i + 1) % n, (2 * i + 2) % n, (7 * i) % n)).alias("page_id"),
    )
    return ids.join(pages.withColumnRenamed("url", "dst"), "page_id").select("src", "dst")


def linked_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures whose pages also link to each other along :func:`page_edges`.

    Anchor texts, ``rel`` and ``class`` take all shapes the link priority looks at.
    """
    pages = table(spark, sf_dir, "pages")
    n = pages.count()
    i = F.col("page_id")
    targets = pages.select(
        F.explode(
            F.array(
                *(F.struct(F.lit(k).alias("k"), t.alias("id"), i.alias("page_id"))
                  for k, t in enumerate(((2 * i + 1) % n, (2 * i + 2) % n, (7 * i) % n)))
            )
        ).alias("t")
    ).select("t.*")
    urls = pages.select(F.col("page_id").alias("id"), F.col("url").alias("href"))
    k = F.col("k")
    opening = (
        F.when(k == 0, '<a class="content" href="')
        .when(k == 1, "<a rel=nofollow class='main-nav' href=\"")
        .otherwise('<A title="a > b" HREF="')
    )
    text = F.when(k == 0, "Latest news").when(k == 1, "Login").otherwise("see &amp; <i>read</i>")
    anchors = (
        targets.join(urls, "id")
        .select("page_id", "k", F.concat(opening, "href", F.lit('">'), text, F.lit("</a>"))
                .alias("a"))
        .groupBy("page_id")
        .agg(*(F.max(F.when(k == n_, F.col("a"))).alias(f"a{n_}") for n_ in range(3)))
        .select("page_id", F.concat("a0", "a1", "a2").alias("anchors"))
    )
    joined = pages.join(anchors, "page_id")
    html = F.concat("html", "anchors")
    return captured_pages(joined.select("page_id", "url", html.alias("html")))
