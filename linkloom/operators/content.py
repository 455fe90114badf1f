"""Page features and scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import html as H, scoring as S
from ..functions.entities import decode_all

# Class hints for sharing buttons and breadcrumb navigation.
SOCIAL_CLASS, SOCIAL_HINTS = "share|social", ("share", "social")
BREADCRUMB_CLASS = r"(?:\A|\s)breadcrumb(?:\s|\z)"

FEATURES = (
    "title", "size", "hash", "text_len", "n_headings", "n_paragraphs", "has_meta_description",
    "has_article", "has_navigation", "has_social", "content_quality", "link_density", "importance",
)


# What a page is cut into; only its anchors are of use beyond the features.
CUT = ("pieces", "names", "texts")


def marked_pages(captures: DataFrame) -> DataFrame:
    """Captures with the page cut at its tags (:data:`CUT`) and its ``a`` elements in ``anchors``, which features and links
    share; failed fetches have neither."""
    pieces, names, texts = map(F.col, CUT)
    cut = captures.withColumn("pieces", H.pieces_of(F.col("html"))).withColumns(
        {"names": F.transform(pieces, H.name_of), "texts": F.transform(pieces, H.text_of)}
    )
    return cut.withColumn("anchors", H.anchors_of(pieces, names, texts))


def with_features(marked: DataFrame) -> DataFrame:
    """Add all :data:`FEATURES` to a table with ``html`` and the columns of :func:`marked_pages`, of which ``anchors`` stays.

    Written as stages: what several features share is a column of an earlier stage, so each
    pass over the page text happens once.
    """
    pieces, names, texts = map(F.col, CUT)
    stage = marked.withColumns(
        {
            "_start": H.body_start(names, texts),
            "_tags": H.tag_sequence(names),
            "_breadcrumb": H.has_class(F.col("html"), pieces, names, BREADCRUMB_CLASS, ("breadcrumb",)),
            "size": F.octet_length("html").cast("long"),
            "hash": F.md5("html"),
            "has_meta_description": H.has_attribute_value(pieces, names, "meta", "name", "description"),
            "has_social": H.has_class(F.col("html"), pieces, names, SOCIAL_CLASS, SOCIAL_HINTS),
        }
    )
    tags, start, links = F.col("_tags"), F.col("_start"), F.col("anchors")
    stage = stage.withColumns(
        {
            "_source": F.array(
                H.title_source(pieces, names),
                H.body_text(pieces, names, texts, start),
                F.array_join(F.transform(links, lambda a: a["text"]), ""),
                H.raw_text(pieces, names, start, F.size(names)),
                F.array_join(F.filter(F.transform(links, lambda a: a["raw"]), lambda r: r != ""), "\n"),
            ),
            "n_headings": H.count_headings(tags),
            "n_paragraphs": H.count_paragraphs(tags),
            "has_article": H.has_element(tags, "article"),
            "has_navigation": H.has_element(tags, "nav") | F.col("_breadcrumb"),
        }
    )
    stage = stage.withColumn("_text", decode_all(F.col("_source")))
    source, text = F.col("_source"), F.col("_text")

    def text_bytes(i: int, raw: int) -> Column:
        # Decoding shortened script-like content too; that length is added back.
        lost = F.octet_length(source[raw]) - F.octet_length(text[raw])
        return F.octet_length(text[i]) + lost

    stage = stage.withColumns(
        {
            "title": text[0],
            "_body_len": text_bytes(1, 3),
            "_anchor_len": text_bytes(2, 4),
            "_trimmed": F.octet_length(text[1]) - F.octet_length(H.trim_unicode(text[1])),
        }
    )
    stage = stage.withColumn("text_len", F.col("_body_len") - F.col("_trimmed"))
    scored = stage.withColumns(
        {
            "content_quality": S.content_quality(
                F.col("text_len"), F.col("n_headings"), F.col("n_paragraphs"),
                F.col("has_meta_description"),
            ),
            "link_density": S.link_density(F.col("_anchor_len"), F.col("_body_len")),
            "importance": S.importance(
                F.octet_length("title"), F.col("has_article"), F.col("has_navigation"),
                F.col("has_social"),
            ),
        }
    )
    kept = [c for c in marked.columns if c not in (*FEATURES, *CUT)]
    return scored.select(*kept, *FEATURES)


def analyze_content(captures: DataFrame) -> DataFrame:
    """All features and scores per capture. Narrow output: the page text itself is dropped."""
    return with_features(marked_pages(captures)).drop("html", "anchors")
