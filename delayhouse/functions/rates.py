"""Exact decimal rounding of ratios of non-negative counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio_half_up(num: Column, den: Column, digits: int) -> Column:
    """num / den rounded half up to ``digits`` places as DOUBLE; null when the denominator is 0 or null.

    Integer arithmetic, so the result does not depend on how a double quotient happens to fall.
    """
    scale = 10**digits
    n, d = num.cast("long"), F.nullif(den.cast("long"), F.lit(0).cast("long"))
    twice = n * F.lit(2 * scale).cast("long") + d
    return (twice - F.pmod(twice, d * 2)) / (d * 2) / F.lit(float(scale))


def percent_half_up(num: Column, den: Column, digits: int) -> Column:
    """100 * num / den, rounded like :func:`ratio_half_up`."""
    return ratio_half_up(num.cast("long") * 100, den, digits)
