"""Text to whole numbers, with the two parsing rules the feeds need.

Text is matched before it is cast: a failed `try_cast` is caught inside Spark as an
exception, some thirty times slower than a pattern that does not match.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from daystar.functions.columns import as_column

# Digits, then a decimal part if any. Casts ignore blanks and control characters around.
_BLANKS = r"[\x00-\x20\x7F]*"
_WHOLE_TEXT = rf"^{_BLANKS}([+-]?[0-9]+){_BLANKS}$"
_DECIMAL_TEXT = rf"^{_BLANKS}([+-]?[0-9]*)[.][0-9]*{_BLANKS}$"


def strict_long(column):
    """Whole number, or NULL for anything that is not one."""
    return F.when(as_column(column).rlike(_WHOLE_TEXT), as_column(column).try_cast("bigint"))


def lenient_long(column):
    """Whole number; a decimal is cut at its point; anything else is NULL.

    Gives what a cast gives with ANSI mode off, whatever the session's mode is.
    """
    text = as_column(column)
    cut = F.regexp_extract(text, _DECIMAL_TEXT, 1)
    # A decimal without digits before its point is cut to nothing, which counts as zero.
    digits = F.when(cut.isin("", "+", "-"), F.lit("0")).otherwise(cut)
    decimal = F.when(text.rlike(_DECIMAL_TEXT), digits.try_cast("bigint"))
    return F.coalesce(strict_long(text), decimal)
