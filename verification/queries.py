"""One query per operator, each over whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from linkloom.functions import report_texts as R, scoring as S, urls as U
from linkloom.operators import content, dedup, frontier as FR, links as L, outcomes as O, similar
from linkloom.operators import pages as P
from linkloom.plans import bfs, expand, reports
from linkloom.session import scratch_path, stored
from linkloom.sources import frontier_table, link_table
from linkloom.sources.captures import captured_pages as as_captures
from linkloom.sources.tables import read_table, write_table
from linkloom.streaming import streams

from . import inputs as I

START = "2024-01-01 00:00:00"
LATER = "2024-01-02 00:00:00"
BATCH = 100
MAX_DEPTH = 4

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def at(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def long(name: str) -> Column:
    return F.col(name).cast("long").alias(name)


# --- sources and sinks ---------------------------------------------------------------------


@query
def captured_pages(spark, sf_dir):
    return I.captures(spark, sf_dir).select(
        "url", F.md5("html").alias("html_md5"), long("status_code"), "content_type",
        "load_time_ms",
    )


@query
def seed_frontier(spark, sf_dir):
    pages = I.table(spark, sf_dir, "pages")
    best = FR.seed_frontier(pages).withColumn("flavour", F.lit("smart"))
    breadth = FR.seed_frontier(pages, priority=0).withColumn("flavour", F.lit("traditional"))
    return best.unionByName(breadth).select(
        "flavour", "url", long("priority"), long("depth"), "parent_url", "status",
        F.col("context.importance").alias("importance"),
    )


def _stored(captures: DataFrame, depth: int, stamp: str) -> DataFrame:
    """Page rows of captures, with parent, for the upsert."""
    return P.page_rows(
        content.analyze_content(captures).withColumns(
            {
                "depth": F.lit(depth),
                "parent_url": F.concat(F.lit("parent-"), F.lit(depth).cast("string")),
                "captured_at": at(stamp),
            }
        )
    )


@query
def upsert_pages(spark, sf_dir):
    """Pages stored first under their URL, then captured again without the fragment."""
    captures = I.captures(spark, sf_dir)
    again = captures.withColumns(
        {
            "url": F.substring_index("url", "#", 1),
            "page_id": F.col("page_id") + 1_000_000,
            "status_code": F.lit(404),
        }
    )
    merged = P.upsert_pages(_stored(captures, 0, START), _stored(again, 3, LATER))
    return merged.select(
        "page_id", "url", long("status_code"), "size", "hash", long("depth"), "parent_url",
        F.unix_seconds("crawled_at").alias("crawled_at"), "importance_score",
    )


@query
def stored_content(spark, sf_dir):
    """Stored pages with their text."""
    captures = I.captures(spark, sf_dir)
    pages = P.page_rows(content.analyze_content(captures))
    return P.attach_content(pages, captures).select(
        "page_id", "url", F.md5("content").alias("content_md5"),
        F.octet_length("content").cast("long").alias("content_bytes"),
    )


@query
def stored_table(spark, sf_dir):
    """A table written in two versions; readers see the second."""
    root = scratch_path(spark, "stored")
    pages = content.analyze_content(I.captures(spark, sf_dir)).select("page_id", "url", "size")
    write_table(pages.withColumn("status", F.lit("pending")), root, partition_by=["status"])
    write_table(pages.withColumn("status", F.lit("completed")), root, partition_by=["status"])
    return read_table(spark, root).select("page_id", "url", "size", "status")


@query
def similar_content(spark, sf_dir):
    return dedup.similar_content(I.document_pages(spark, sf_dir)).select(
        "probe_id", long("rank"), "page_id", "url", "title", "hash"
    )


@query
def similar_by_hash(spark, sf_dir):
    """Pages with the most frequent body."""
    pages = I.document_pages(spark, sf_dir)
    top = pages.groupBy("hash").count().orderBy(F.desc("count"), "hash").first()["hash"]
    return dedup.similar_by_hash(pages, top)


@query
def near_duplicates(spark, sf_dir):
    """Groups of documents whose five-word shingles have a Jaccard similarity of 0.8 or more."""
    pages = I.table(spark, sf_dir, "documents").withColumnRenamed("doc_id", "page_id")
    return similar.near_duplicates(pages, F.col("text")).select(
        "page_id", long("n_shingles"), "group_id", "similarity", "is_first"
    )


# --- URL functions -------------------------------------------------------------------------


@query
def valid_urls(spark, sf_dir):
    """Page URLs, altered so that every reason for rejection occurs."""
    pages = I.table(spark, sf_dir, "pages").select("page_id", "url")
    url = F.col("url")
    shapes = F.array(
        url,
        F.regexp_replace(url, "^https?", "ftp"),
        F.regexp_replace(url, "^https?://[^/]+", ""),
        F.regexp_replace(url, "^http", "HTTP"),
        F.concat(url, F.lit("/data.json")),
        F.concat(url, F.lit("?file=A.PDF")),
        F.regexp_replace(url, "://", "://www.icons."),
        F.concat(F.lit("mailto:"), url),
        F.lit(""),
    )
    rows = pages.select("page_id", F.posexplode(shapes).alias("shape", "url"))
    return rows.select(
        "page_id", long("shape"), "url", U.is_valid_url(F.col("url")).alias("valid"),
        U.is_valid_url(F.col("url"), strict=True).alias("valid_strict"),
    )


@query
def url_normalized(spark, sf_dir):
    pages = I.table(spark, sf_dir, "pages").select("page_id", "url")
    url = F.col("url")
    site = F.regexp_extract(url, "^https?://[^/]+", 0)
    query_part = F.regexp_extract(url, r"\?[^#]*", 0)
    shapes = F.array(url, site, F.concat(site, F.lit("#t")), F.concat(site, query_part))
    rows = pages.select("page_id", F.posexplode(shapes).alias("shape", "url"))
    return rows.select(
        "page_id", long("shape"), "url", U.normalize_url(F.col("url")).alias("normalized")
    )


def _hrefs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All hrefs of all pages in eight shapes of reference."""
    pages = I.table(spark, sf_dir, "pages")
    href = F.explode(F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), 1))
    rows = pages.select("page_id", "url", href.alias("href")).distinct()
    h, name = F.col("href"), F.expr("substr(href, 2)")
    shapes = F.array(
        h, name, F.concat(F.lit("../"), name), F.concat(F.lit("?y="), name),
        F.concat(F.lit("#"), name), F.concat(F.lit("//other.example.org"), h), F.lit(""),
        F.concat(F.regexp_replace("url", "^https?://[^/]+|[?#].*", ""), F.lit("#"), name),
    )
    return rows.select("page_id", "url", F.posexplode(shapes).alias("shape", "href"))


@query
def resolved_links(spark, sf_dir):
    return _hrefs(spark, sf_dir).select(
        "page_id", long("shape"), "href",
        U.resolve_url(F.col("url"), F.col("href")).alias("resolved"),
    )


@query
def resolved_links_other_page(spark, sf_dir):
    resolved = U.resolve_url(F.col("url"), F.col("href"), drop_same_page=True)
    return _hrefs(spark, sf_dir).select(
        "page_id", long("shape"), "href", resolved.alias("resolved")
    )


@query
def guessed_types(spark, sf_dir):
    pages = I.table(spark, sf_dir, "pages").select("page_id", "url")
    url = F.col("url")
    words = ("/BLOG/", "/article/news/", "/news/", "/news/doc", "/docs", "/help", "/help/", "/")
    shapes = F.array(*(F.regexp_replace(url, "/(en|fr|es|de)/", w) for w in words))
    rows = pages.select("page_id", F.posexplode(shapes).alias("shape", "url"))
    return rows.select(
        "page_id", long("shape"), "url", U.guess_content_type(F.col("url")).alias("content_type")
    )


@query
def relevant_captures(spark, sf_dir):
    return O.drop_irrelevant(I.mixed_captures(spark, sf_dir)).select(
        "url", "content_type", "seq"
    )


# --- page features -------------------------------------------------------------------------


@query
def page_features(spark, sf_dir):
    return content.analyze_content(I.captures(spark, sf_dir)).select(
        "page_id", "title", "size", "hash", long("text_len"), long("n_headings"),
        long("n_paragraphs"), "has_meta_description", "has_article", "has_navigation",
        "has_social",
    )


@query
def page_scores(spark, sf_dir):
    return content.analyze_content(I.captures(spark, sf_dir)).select(
        "page_id", "size", "hash", "title", "content_quality", "link_density", "importance"
    )


@query
def document_scores(spark, sf_dir):
    """Scores of documents served as bare text pages with sharing links and a description."""
    documents = I.table(spark, sf_dir, "documents")
    html = F.concat(
        F.lit('<meta name="description" content="d"><title>'), F.col("source"),
        F.lit("</title>"), F.col("text"),
        F.when(F.col("lang") == "en", '<a class="btn share-x">share</a>')
        .when(F.col("lang") == "fr", '<div class="top breadcrumb"></div>').otherwise(""),
    )
    captures = documents.select(F.col("doc_id").alias("page_id"), html.alias("html"))
    return content.with_features(content.marked_pages(captures)).select(
        "page_id", "title", long("text_len"), "has_meta_description", "has_navigation",
        "has_social", "content_quality", "link_density", "importance",
    )


# --- links ---------------------------------------------------------------------------------


@query
def extracted_links(spark, sf_dir):
    return L.extract_links(I.captures(spark, sf_dir).select("page_id", "url", "html")).select(
        "page_id", long("pos"), "url", "anchor", "rel"
    )


@query
def scored_links(spark, sf_dir):
    return L.extract_scored_links(I.linked_captures(spark, sf_dir)).select(
        "parent_url", long("pos"), "url", long("priority"), long("depth"),
        F.col("context.importance").alias("importance"),
        F.col("context.content_type").alias("content_type"),
        F.col("context.link_density").alias("link_density"),
    )


@query
def link_priority(spark, sf_dir):
    """Priority of documents taken as anchor texts, over all shapes of ``rel`` and ``class``."""
    documents = I.table(spark, sf_dir, "documents")
    n = F.col("n_chars")
    anchor = F.concat(
        F.when(n % 4 == 1, "Latest News ").when(n % 4 == 2, "Login ")
        .when(n % 4 == 3, "Blog about us ").otherwise(""),
        "text",
    )
    rel = (
        F.when(F.col("lang") == "de", "nofollow").when(F.col("lang") == "fr", "noopener nofollow")
        .when(F.col("lang") == "es", "NOFOLLOW")
    )
    shapes = F.array(
        F.lit(None).cast("string"), F.lit("nav-item"), F.lit("content"), F.lit("nav content"),
        F.lit("Article"), F.lit("menu"),
    )
    scores = F.array(F.lit(0.5), F.lit(0.5) + F.lit(0.2) + F.lit(0.1), F.lit(1.0))
    # A text is searched once, before its row is repeated for every shape.
    searched = documents.select("doc_id", S.anchor_points(anchor).alias("points"), rel.alias("rel"))
    rows = searched.select(
        "*", F.posexplode(shapes).alias("shape", "css_class")
    ).select("*", F.explode(scores).alias("importance"))
    priority = S.link_priority(
        None, F.col("rel"), F.col("css_class"), F.col("importance"), points=F.col("points")
    )
    return rows.select(
        "doc_id", long("shape"), "importance", priority.cast("long").alias("priority")
    )


@query
def page_links(spark, sf_dir):
    return L.page_links(I.linked_captures(spark, sf_dir)).select(
        "source_id", "target_id", "url", "anchor", "rel", long("pos")
    )


@query
def link_arrivals(spark, sf_dir):
    """The link table after pages have come in three arrivals."""
    root, captures = scratch_path(spark, "link-table"), I.linked_captures(spark, sf_dir)
    for arrival in range(3):
        link_table.add_arrival(captures.where(F.col("page_id") % 3 == arrival), root, arrival)
    return link_table.read_links(spark, root).select("source_id", "target_id", "url", "anchor", "rel", long("pos"))


# --- filters and de-duplication --------------------------------------------------------------


@query
def crawled_split(spark, sf_dir):
    frontier = I.mixed_captures(spark, sf_dir).select("url").distinct()
    crawled = I.crawled_pages(spark, sf_dir)
    kept = FR.drop_crawled(frontier, crawled).withColumn("part", F.lit("kept"))
    skipped = FR.already_crawled(frontier, crawled).withColumn("part", F.lit("skipped"))
    return kept.unionByName(skipped)


@query
def dedup_content(spark, sf_dir):
    facts = O.capture_facts(I.mixed_captures(spark, sf_dir)).filter("fetched")
    return dedup.drop_duplicate_content(
        facts.select("hash", "depth", "priority", "seq", "url", "size")
    ).select("hash", long("depth"), long("priority"), "seq", "url", "size")


@query
def unvisited_links(spark, sf_dir):
    """Link targets not met as a page without fragment."""
    links = L.extract_links(I.linked_captures(spark, sf_dir).select("url", "html"))
    return FR.drop_visited(links, I.table(spark, sf_dir, "pages"))


@query
def outcomes(spark, sf_dir):
    return O.classify_outcomes(
        O.capture_facts(I.mixed_captures(spark, sf_dir)), I.crawled_pages(spark, sf_dir)
    ).select(
        "url", "strategy", "outcome", "reason", "size", "load_time_ms",
        F.unix_seconds("ts").alias("ts"),
    )


# --- frontier and graph ----------------------------------------------------------------------


def _frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as seeds, those with a query string already completed."""
    pages = I.table(spark, sf_dir, "pages")
    seeds = FR.seed_frontier(
        pages.select("url", F.timestamp_seconds(F.col("page_id") % 7).alias("scheduled_at"))
    )
    return FR.mark_processed(seeds, I.crawled_pages(spark, sf_dir))


def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = L.extract_scored_links(I.linked_captures(spark, sf_dir))
    rows = FR.frontier_rows(links, F.lit(1), at(START))
    return FR.add_to_frontier(_frontier(spark, sf_dir), rows)


def _frontier_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "url", long("priority"), long("depth"), "parent_url", "status",
        F.unix_seconds("scheduled_at").alias("scheduled_at"),
    )


@query
def frontier_merge(spark, sf_dir):
    return _frontier_columns(_merged(spark, sf_dir))


@query
def next_urls(spark, sf_dir):
    merged, _ = stored(_merged(spark, sf_dir), "frontier")
    within = FR.within_depth(merged, 1)
    return _frontier_columns(FR.next_urls(within, BATCH))


@query
def next_urls_stored(spark, sf_dir):
    """The same batch from a frontier table in order."""
    root = scratch_path(spark, "frontier-table")
    frontier_table.write_frontier(FR.within_depth(_merged(spark, sf_dir), 1), root)
    return _frontier_columns(frontier_table.best_stored(spark, root, BATCH))


@query
def within_depth(spark, sf_dir):
    return _frontier_columns(FR.within_depth(_merged(spark, sf_dir), 0))


@query
def mark_processed(spark, sf_dir):
    return _frontier_columns(_frontier(spark, sf_dir))


def _start_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.table(spark, sf_dir, "pages").filter("page_id % 50 = 0").select("url")


@query
def bfs_depths(spark, sf_dir):
    edges = I.page_edges(spark, sf_dir)
    return bfs.bfs_depths(edges, _start_pages(spark, sf_dir), MAX_DEPTH).select(
        "url", long("depth"), "parent_url"
    )


def _crawl(spark: SparkSession, sf_dir: str, rounds: int) -> tuple[DataFrame, DataFrame]:
    """Frontier after some rounds, each over a batch of half as many URLs as there are pages, and all outcomes."""
    captures = I.linked_captures(spark, sf_dir).withColumn(
        "content_type", I.page_content_type()
    )
    pages = P.page_rows(
        content.analyze_content(I.captures(spark, sf_dir)).filter(F.contains("url", F.lit("?")))
    )
    frontier, _ = stored(_frontier(spark, sf_dir), "frontier")
    state = expand.CrawlState(frontier, stored(pages, "pages")[0])
    site = expand.prepare_site(captures)
    k, outcomes = I.table(spark, sf_dir, "pages").count() // 2, []
    for number in range(1, rounds + 1):
        state = expand.expand_frontier(state, site, k, MAX_DEPTH, F.lit(number), at(START))
        outcomes.append(state.outcomes.withColumn("round", F.lit(number)))
    return state.frontier, reduce(DataFrame.unionByName, outcomes)


@query
def expand_frontier_1(spark, sf_dir):
    """The frontier after one round."""
    return _frontier_columns(_crawl(spark, sf_dir, rounds=1)[0])


@query
def expand_frontier_outcomes(spark, sf_dir):
    """Outcomes of three rounds: URLs found in one are decided in the next."""
    return _crawl(spark, sf_dir, rounds=3)[1].select(
        long("round"), "url", "outcome", "reason", "size"
    )


@query
def frontier_resume(spark, sf_dir):
    """Two merges whose links carry the same ``seq``; URLs of the first are completed in between."""
    merged = _merged(spark, sf_dir)
    done = merged.filter(F.col("depth") == 0).select("url")
    links = L.extract_scored_links(I.linked_captures(spark, sf_dir)).withColumn("depth", F.lit(7))
    again = FR.frontier_rows(links, F.lit(0), at(LATER))
    return _frontier_columns(FR.add_to_frontier(FR.mark_processed(merged, done), again))


# --- reports -----------------------------------------------------------------------------------


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.event_outcomes(I.table(spark, sf_dir, "events"))


@query
def crawl_stats(spark, sf_dir):
    return reports.crawl_stats(_outcomes(spark, sf_dir))


@query
def skip_reasons(spark, sf_dir):
    return reports.skip_reasons(_outcomes(spark, sf_dir))


@query
def avg_load_time(spark, sf_dir):
    return reports.avg_load_time(_outcomes(spark, sf_dir))


@query
def throughput(spark, sf_dir):
    return reports.throughput(_outcomes(spark, sf_dir))


@query
def compare_strategies(spark, sf_dir):
    return reports.compare_strategies(_outcomes(spark, sf_dir))


@query
def improvement(spark, sf_dir):
    """Change of clicks against purchases for every user, both ways, as number and text."""
    per_user = I.table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.count_if(F.col("event_type") == "click").alias("base"),
        F.count_if(F.col("event_type") == "purchase").alias("new"),
    )
    pct = R.improvement_pct(F.col("base"), F.col("new"))
    reverse = R.improvement_pct_reverse(F.col("base"), F.col("new"))
    return per_user.select(
        "user_id", "base", "new", pct.alias("pct"), reverse.alias("pct_reverse"),
        R.improvement_text(pct).alias("text"), R.improvement_text(reverse).alias("text_reverse"),
    )


@query
def format_bytes(spark, sf_dir):
    """Order prices as byte counts, from bytes to exabytes, with ties of the last decimal."""
    orders = I.table(spark, sf_dir, "orders")
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    sizes = F.array(
        cents % 1100, cents, cents * 256, cents * 1024 * 1024, cents * 1_000_003,
        cents * 1024 * 1024 * 256, (cents % 7_000_000) * 1_000_003 * 1_000_003,
    )
    rows = orders.select("o_orderkey", F.posexplode(sizes).alias("shape", "n"))
    return rows.select(
        "o_orderkey", long("shape"), "n", R.format_bytes(F.col("n")).alias("text")
    )


@query
def crawl_metrics(spark, sf_dir):
    return reports.crawl_metrics(_outcomes(spark, sf_dir)).select(
        F.unix_seconds("window_start").alias("window_start"), "outcome", "reason", "n",
        "per_second",
    )


@query
def quality_report(spark, sf_dir):
    documents = I.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("page_id"), F.col("text").alias("html")
    )
    report = reports.quality_report(
        content.with_features(content.marked_pages(documents)).select("hash", "content_quality")
    )
    return report.select(
        "pages", "distinct_bodies",
        F.round("avg_content_quality", 9).alias("avg_content_quality"),
        F.round("duplicate_share", 9).alias("duplicate_share"),
    )


# --- streams -----------------------------------------------------------------------------------


SLICES = 4


def _in_batches(
    spark: SparkSession, rows: DataFrame, place: Column, start: Callable[[DataFrame], StreamingQuery]
) -> None:
    """Feed a table to a stream in ``SLICES`` micro-batches; ``place`` (0 to SLICES - 1) says which row comes when."""
    source = scratch_path(spark, "source")
    for n in range(SLICES):
        rows.filter(place == n).write.mode("append").parquet(source)
        start(spark.readStream.schema(rows.schema).parquet(source)).awaitTermination()


def _page_slice(pages: DataFrame) -> Column:
    top = pages.agg(F.max("page_id")).first()[0]
    return F.floor(F.col("page_id") * SLICES / F.lit(top + 1))


def _sink(stream: DataFrame, root: str, mode: str) -> StreamingQuery:
    """One micro-batch of a stream into the table below ``root``; a complete result replaces the one before."""

    def write(batch: DataFrame, batch_id: int) -> None:
        target = f"{root}/out" if mode == "complete" else f"{root}/out/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(target)

    return (
        stream.writeStream.outputMode(mode).foreachBatch(write)
        .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    )


@query
def stream_score(spark, sf_dir):
    root, pages = scratch_path(spark, "score"), I.table(spark, sf_dir, "pages")

    def start(stream: DataFrame) -> StreamingQuery:
        return streams.stream_score(as_captures(stream), root, f"{root}/checkpoint")

    _in_batches(spark, pages, _page_slice(pages), start)
    return streams.read_scored(spark, root).select(
        "page_id", "url", "title", "size", "hash", "importance_score", "content_quality",
        "link_density",
    )


@query
def stream_score_faults(spark, sf_dir):
    """A stream with failed fetches, irrelevant types and pages captured again: what is stored of it, and what isn't."""
    root, captures = scratch_path(spark, "faults"), I.mixed_captures(spark, sf_dir)

    def start(stream: DataFrame) -> StreamingQuery:
        return streams.stream_score(stream, root, f"{root}/checkpoint")

    source = F.floor(F.col("seq") / 1_000_000_000)
    _in_batches(spark, captures, F.when(source == 0, F.col("seq") % 2).otherwise(source + 1), start)
    stored_rows = streams.read_scored(spark, root).select(
        "url", "size", "hash", long("depth"), F.lit(None).cast("string").alias("reason")
    )
    faults = streams.read_faults(spark, root).select(
        "url", F.lit(None).cast("long").alias("size"), F.lit(None).cast("string").alias("hash"),
        F.lit(None).cast("long").alias("depth"), "reason",
    )
    return stored_rows.unionByName(faults)


@query
def stream_dedup(spark, sf_dir):
    root = scratch_path(spark, "dedup")
    documents = I.table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("html"))

    def start(stream: DataFrame) -> StreamingQuery:
        return _sink(streams.stream_dedup(stream).select("hash", "size"), root, "append")

    _in_batches(spark, documents, F.pmod("doc_id", F.lit(SLICES)), start)
    return spark.read.parquet(f"{root}/out").select("hash", long("size"))


@query
def stream_unique(spark, sf_dir):
    """Bodies kept by a stream whose memory is its store."""
    root = scratch_path(spark, "unique")
    documents = I.table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("html"))

    def start(stream: DataFrame) -> StreamingQuery:
        return streams.stream_unique(stream, root, f"{root}/checkpoint")

    _in_batches(spark, documents, F.pmod("doc_id", F.lit(SLICES)), start)
    return streams.read_unique(spark, root).select("hash", long("size"))


@query
def stream_frontier(spark, sf_dir):
    root, pages = scratch_path(spark, "frontier"), I.table(spark, sf_dir, "pages")

    def start(stream: DataFrame) -> StreamingQuery:
        rows = FR.frontier_rows(L.extract_scored_links(as_captures(stream)), F.lit(1), at(START))
        return streams.stream_frontier(rows, root, f"{root}/checkpoint")

    _in_batches(spark, pages, _page_slice(pages), start)
    return _frontier_columns(streams.read_frontier(spark, root))


def _event_slice(events: DataFrame) -> Column:
    """Slices in the order of time."""
    first, last = events.agg(F.min(F.unix_micros("ts")), F.max(F.unix_micros("ts"))).first()
    return F.floor((F.unix_micros("ts") - F.lit(first)) * SLICES / F.lit(last - first + 1))


@query
def stream_stats(spark, sf_dir):
    root, events = scratch_path(spark, "stats"), _events(spark, sf_dir)

    def start(stream: DataFrame) -> StreamingQuery:
        return _sink(streams.stream_stats(I.event_outcomes(stream)), root, "complete")

    _in_batches(spark, events, _event_slice(events), start)
    return spark.read.parquet(f"{root}/out")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


@query
def stream_stats_windowed(spark, sf_dir):
    """Hourly counters of the windows that the watermark has closed."""
    root, events = scratch_path(spark, "windows"), _events(spark, sf_dir)

    def start(stream: DataFrame) -> StreamingQuery:
        stats = streams.stream_stats(I.event_outcomes(stream), window="1 hour").select(
            F.unix_seconds("window.start").alias("window_start"), "strategy", "pages_processed",
            "pages_skipped", "errors", "total_size",
        )
        return _sink(stats, root, "append")

    _in_batches(spark, events, _event_slice(events), start)
    return spark.read.parquet(f"{root}/out").drop("batch_id")
