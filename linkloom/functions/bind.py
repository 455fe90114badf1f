"""Small expression helper shared by the column functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``.

    A Column used in several places is repeated in the expression tree; binding it
    to a lambda variable keeps nested string work linear.
    """
    return F.element_at(F.transform(F.array(value), body), 1)
