"""Texts and ratios of crawl reports."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .bind import bind

# Byte units in steps of 1024, and the text for a missing ratio.
BYTE_UNITS = "KMGTPE"
NOT_AVAILABLE = "N/A"
_BEYOND_LONG = float(2**63)


def _large(v: Column) -> Column:
    """Digits of a double from 2**63 to 2**74; those are multiples of 2048."""
    blocks = (v / F.lit(2048.0)).cast("long").cast("decimal(20,0)") * F.lit(2048)
    return blocks.cast("decimal(38,0)").cast("string")


def one_decimal(value: Column) -> Column:
    """A non-negative double with one decimal, rounded on its exact binary value.

    Spark's formatter rounds the shortest decimal text half up, which turns 0.35 (in binary just
    below) into 0.4 and the tie 1.25 into 1.3; the C rule gives 0.3 and 1.2. Rounding ten times
    the value half to even differs from that only where the product falls on a half by its own
    rounding; there the rounding error of the product decides.
    """

    def rounded(v: Column) -> Column:
        whole = F.floor(v)
        part = v - whole.cast("double")
        eight, two = part * 8.0, part * 2.0
        ten = eight + two
        added = ten - eight
        error = (eight - (ten - added)) + (two - added)
        below = F.floor(ten).cast("double")
        nearest = F.when(
            (ten - below == 0.5) & (error != 0.0),
            F.when(error > 0.0, below + 1.0).otherwise(below),
        ).otherwise(F.rint(ten))
        carry = F.when(nearest == 10.0, 1).otherwise(0)
        digit = (nearest.cast("int") % 10).cast("string")
        return F.when(
            v < _BEYOND_LONG, F.concat((whole + carry).cast("string"), F.lit("."), digit)
        ).otherwise(F.concat(_large(v), F.lit(".0")))

    return bind(value.cast("double"), rounded)


def format_bytes(n: Column) -> Column:
    """``1023 B``, ``1.5 KB``, ...: the largest unit that leaves at least 1, one decimal."""
    size = n.cast("long")
    scaled, unit = size.cast("double"), F.lit("B")
    for power, letter in enumerate(BYTE_UNITS, start=1):
        fits = size >= F.lit(1024**power)
        scaled = F.when(fits, size.cast("double") / F.lit(float(1024**power))).otherwise(scaled)
        unit = F.when(fits, F.lit(letter + "B")).otherwise(unit)
    number = F.when(size < 1024, size.cast("string")).otherwise(one_decimal(scaled))
    return F.concat(number, F.lit(" "), unit)


def improvement_pct(base: Column, new: Column) -> Column:
    """Change from ``base`` to ``new`` in percent of ``base``; NULL for base 0."""
    b, n = base.cast("double"), new.cast("double")
    return F.when(b != 0.0, F.try_divide(n - b, b) * 100.0)


def improvement_pct_reverse(base: Column, new: Column) -> Column:
    """Reduction from ``base`` to ``new`` in percent of ``base``: less is better."""
    b, n = base.cast("double"), new.cast("double")
    return F.when(b != 0.0, F.try_divide(b - n, b) * 100.0)


def improvement_text(pct: Column) -> Column:
    """``+50.0%``, ``-50.0%``, ``0%`` or ``N/A``."""
    return (
        F.when(pct.isNull(), F.lit(NOT_AVAILABLE))
        .when(pct > 0, F.concat(F.lit("+"), one_decimal(F.abs(pct)), F.lit("%")))
        .when(pct < 0, F.concat(F.lit("-"), one_decimal(F.abs(pct)), F.lit("%")))
        .otherwise("0%")
    )
