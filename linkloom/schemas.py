"""Schemas of the tables the engine reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _L, _D, _T = (
    T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.TimestampType()
)


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


CAPTURES = _schema(
    url=_S, html=_S, status_code=_I, content_type=_S, load_time_ms=_L, captured_at=_T
)

CONTEXT = _schema(importance=_D, content_type=_S, link_density=_D)

PAGES = _schema(
    page_id=_L, url=_S, title=_S, content=_S, status_code=_I, content_type=_S, size=_L,
    load_time_ms=_L, depth=_I, parent_url=_S, crawled_at=_T, hash=_S, importance_score=_D,
    content_quality=_D, link_density=_D,
)

LINKS = _schema(source_id=_L, target_id=_L, url=_S, anchor=_S, rel=_S)

FRONTIER = _schema(
    url=_S, priority=_I, depth=_I, parent_url=_S, scheduled_at=_T, seq=_L, status=_S,
    context=CONTEXT,
)

OUTCOMES = _schema(
    url=_S, strategy=_S, outcome=_S, reason=_S, size=_L, load_time_ms=_L, ts=_T
)

# Frontier states and outcome labels.
PENDING, COMPLETED = "pending", "completed"
PROCESSED, SKIPPED, ERROR = "processed", "skipped", "error"
ALREADY_CRAWLED = "already_crawled"
IRRELEVANT_TYPE = "irrelevant_content_type"
DUPLICATE = "duplicate_content"
NOT_CAPTURED = "not_captured"
FETCH_FAILED = "fetch_failed"
