"""Captured pages as input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..schemas import CAPTURES


def _column_or(df: DataFrame, name: str, default: Column) -> Column:
    return F.col(name) if name in df.columns else default


def captured_pages(df: DataFrame) -> DataFrame:
    """Any table with ``url`` and ``html`` as captures; other columns it has are kept.

    No filter on the status code: error pages are stored too. Missing columns get the values
    of a plain successful HTML fetch.
    """
    defaults = {
        "status_code": F.lit(200),
        "content_type": F.lit("text/html"),
        "load_time_ms": F.lit(None),
        "captured_at": F.lit(None),
    }
    known = [
        _column_or(df, f.name, defaults.get(f.name)).cast(f.dataType).alias(f.name)
        for f in CAPTURES.fields
    ]
    extra = [F.col(c) for c in df.columns if c not in CAPTURES.fieldNames()]
    return df.select(*extra, *known)
