"""Content scores and link priority.

All scores add double literals in a fixed order: 0.5 + 0.2 + 0.1 is 0.7999999999999999, and
a twentieth of it truncates to 15, not 16. A page that was not fetched has no scores: they are NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .html import trim_unicode

# Keyword lists, weights and limits of the scoring rules.
HIGH_PRIORITY_WORDS = (
    "article", "news", "blog", "content", "post", "story", "research", "documentation",
)
LOW_PRIORITY_WORDS = (
    "login", "register", "contact", "about", "terms", "privacy", "sitemap",
)
BASE_PRIORITY = 50
MIN_PRIORITY, MAX_PRIORITY = 1, 100


def _points(condition: Column, points: float) -> Column:
    return F.when(condition, F.lit(points)).otherwise(F.lit(0.0))


def content_quality(
    text_len: Column, n_headings: Column, n_paragraphs: Column, has_description: Column
) -> Column:
    score = (
        F.lit(0.0)
        + _points(text_len > 500, 0.3)
        + _points(text_len > 2000, 0.2)
        + _points(n_headings > 0, 0.2)
        + _points(n_paragraphs > 3, 0.2)
        + _points(has_description, 0.1)
    )
    return F.when(text_len.isNotNull(), F.least(score, F.lit(1.0)))


def link_density(link_text_len: Column, body_len: Column) -> Column:
    ratio = F.try_divide(link_text_len.cast("double"), body_len.cast("double"))
    return F.when(body_len == 0, F.lit(0.0)).when(
        body_len.isNotNull(), F.least(ratio, F.lit(1.0))
    )


def importance(
    title_len: Column, has_article: Column, has_navigation: Column, has_social: Column
) -> Column:
    score = (
        F.lit(0.5)
        + _points((title_len > 10) & (title_len < 70), 0.1)
        + _points(has_article, 0.2)
        + _points(has_navigation, 0.1)
        + _points(has_social, 0.1)
    )
    return F.when(title_len.isNotNull(), F.least(score, F.lit(1.0)))


def _bonus(condition: Column, points: int) -> Column:
    return F.when(condition, F.lit(points)).otherwise(F.lit(0))


def anchor_points(anchor: Column) -> Column:
    """What the words of an anchor text add to the priority of its links."""
    words = F.lower(trim_unicode(anchor))
    return (
        _bonus(words.rlike("|".join(HIGH_PRIORITY_WORDS)), 20)
        + _bonus(words.rlike("|".join(LOW_PRIORITY_WORDS)), -15)
    )


def link_priority(
    anchor: Column | None, rel: Column, css_class: Column, page_importance: Column, points: Column | None = None
) -> Column:
    """Crawl priority of a link, 1 to 100. ``rel`` and ``css_class`` may be NULL.

    Many links with one text: ``points`` are its :func:`anchor_points`, taken once, in place of the ``anchor``.
    """
    priority = (
        F.lit(BASE_PRIORITY)
        + (anchor_points(anchor) if points is None else points)
        + _bonus(F.contains(rel, F.lit("nofollow")), -30)
        + _bonus(css_class.rlike("nav|menu"), -10)
        + _bonus(css_class.rlike("content|article"), 15)
        + (page_importance * F.lit(20.0)).cast("int")
    )
    return F.greatest(F.lit(MIN_PRIORITY), F.least(F.lit(MAX_PRIORITY), priority)).cast("int")
