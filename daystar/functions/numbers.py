"""Guarded ratios."""

from __future__ import annotations

from pyspark.sql import functions as F

from daystar.functions.columns import as_column


def ratio(numerator, denominator, guard="positive"):
    """Double ratio that never divides by zero.

    `guard="positive"` gives NULL unless the denominator is above zero;
    `guard="nonzero"` gives NULL for zero only, so a negative one still divides.
    """
    top, bottom = as_column(numerator).cast("double"), as_column(denominator)
    if guard == "positive":
        return F.when(bottom > 0, top / bottom)
    if guard == "nonzero":
        return top / F.nullif(bottom, F.lit(0))
    raise ValueError(f"unknown guard: {guard!r}")


def percent(numerator, denominator, decimals=2):
    """Ratio as a percentage, rounded half up; NULL unless the denominator is above zero."""
    return F.round(ratio(numerator, denominator) * 100, decimals)
