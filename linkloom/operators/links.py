"""Links out of captured pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import html as H, scoring as S, urls as U
from ..functions.bind import bind
from ..functions.entities import decode_all, decode_entities
from ..schemas import PENDING
from .content import marked_pages, with_features


# Columns of a page that its links inherit from.
PAGE_CONTEXT = ["url", "depth", "importance", "link_density"]


def _link(anchor: Column, base: Column, drop_same_page: bool) -> Column:
    values = bind(
        H.attributes(anchor["tag"]),
        lambda a: decode_all(
            F.array(*(H.attribute_value(a, name) for name in ("href", "rel", "class"))),
            attribute=True,
        ),
    )
    return bind(
        values,
        lambda v: F.struct(
            U.resolve_on(base, v[0], drop_same_page).alias("url"),
            decode_entities(anchor["text"]).alias("anchor"),
            v[1].alias("rel"),
            v[2].alias("css_class"),
        ),
    )


def link_array(drop_same_page: bool) -> Column:
    """Links of a marked page (columns ``url`` and ``anchors``) in document order.

    Links are finished inside the array, before it is exploded: a later filter on the link URL
    then tests a value and cannot make Spark resolve it a second time.
    """
    return bind(
        U.parse_url(F.col("url")),
        lambda base: F.transform(
            F.col("anchors"), lambda a: _link(a, base, drop_same_page)
        ),
    )


def explode_links(pages: DataFrame, links: Column, keep: list[str]) -> DataFrame:
    """One row per link that could be resolved; the page text ends here."""
    rows = pages.select(*keep, F.posexplode(links).alias("pos", "link"))
    return rows.filter(F.col("link.url").isNotNull())


def extract_links(captures: DataFrame) -> DataFrame:
    """Every ``a[href]`` with its absolute URL, in document order and with repeats.

    Keeps the columns of ``captures`` except the page text; ``source_url`` is the page.
    """
    keep = [c for c in captures.columns if c != "html"]
    links = explode_links(marked_pages(captures), link_array(drop_same_page=False), keep)
    return links.withColumnRenamed("url", "source_url").select(
        *[c for c in keep if c != "url"], "source_url", "pos",
        F.col("link.url").alias("url"), F.col("link.anchor").alias("anchor"),
        F.col("link.rel").alias("rel"),
    )


def extract_scored_links(captures: DataFrame) -> DataFrame:
    """Frontier candidates: valid links with priority, depth, parent and context.

    ``captures`` may have a ``depth`` column (0 when absent). Page scores and links come out of
    one pass over the page text.
    """
    if "depth" not in captures.columns:
        captures = captures.withColumn("depth", F.lit(0))
    pages = with_features(marked_pages(captures)).select(*PAGE_CONTEXT, "anchors")
    return score_links(explode_links(pages, link_array(drop_same_page=True), PAGE_CONTEXT))


def score_links(links: DataFrame) -> DataFrame:
    """Keep valid links and give them priority and context."""
    link = F.col("link")
    priority = S.link_priority(link.anchor, link.rel, link.css_class, F.col("importance"))
    return (
        links.filter(U.is_valid_url(link.url))
        .withColumn("priority", priority)
        .select(
            link.url.alias("url"),
            "priority",
            (F.col("depth") + 1).cast("int").alias("depth"),
            F.col("url").alias("parent_url"),
            "pos",
            F.lit(PENDING).alias("status"),
            link_context(F.col("priority"), link.url, F.col("link_density")).alias("context"),
        )
    )


def link_context(priority: Column, url: Column, page_link_density: Column) -> Column:
    """Context of a scored link: importance from its priority, the page's link density."""
    return F.struct(
        (priority / F.lit(100.0)).alias("importance"),
        U.guess_content_type(url).alias("content_type"),
        page_link_density.alias("link_density"),
    )


def page_links(captures: DataFrame) -> DataFrame:
    """The link table: source and target ids, URL, anchor text and ``rel``.

    ``target_id`` is NULL when the target was not captured. URLs of captures are unique, so the
    join adds no rows. Many links may share a hub URL: the other side of the join has one narrow
    row per URL, so AQE can split a hot link partition at little cost.
    """
    links = extract_links(captures.select("page_id", "url", "html"))
    targets = captures.select(F.col("page_id").alias("target_id"), "url")
    return links.join(targets, "url", "left").select(
        F.col("page_id").alias("source_id"), "target_id", "url", "anchor", "rel", "pos"
    )
