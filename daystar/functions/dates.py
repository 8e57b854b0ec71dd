"""Dates, date keys and their parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from daystar.functions.columns import as_column

# Fixed value: text format of dates in the marts.
LABEL_FORMAT = "yyyy-MM-dd"

# Eight digits.
_COMPACT_TEXT = "^[0-9]{8}$"


def iso_date(column):
    """`yyyy-MM-dd` text to a date; NULL if malformed."""
    return as_column(column).try_cast("date")


def compact_date(column):
    """`yyyyMMdd` text or number to a date; NULL if malformed."""
    text = as_column(column).cast("string")
    # Matched first: text that fails to parse would cost an exception per row.
    dashed = F.concat_ws("-", *date_key_parts(text).values())
    return F.when(text.rlike(_COMPACT_TEXT), dashed.try_cast("date"))


def date_key(column):
    """Date to its whole-number key, 2020-05-01 to 20200501."""
    date = as_column(column)
    return (F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)).cast("int")


def date_key_text(column):
    """`yyyy-MM-dd` text to a text key, by dropping the dashes."""
    return F.regexp_replace(as_column(column), "-", "")


def date_label(column):
    """Date to `yyyy-MM-dd` text."""
    return F.date_format(as_column(column), LABEL_FORMAT)


def date_parts(column):
    date = as_column(column)
    return {"year": F.year(date), "month": F.month(date), "day": F.dayofmonth(date)}


def date_key_parts(column):
    """Year, month and day text of a `yyyyMMdd` text key."""
    key = as_column(column)
    return {
        "year": F.substring(key, 1, 4),
        "month": F.substring(key, 5, 2),
        "day": F.substring(key, 7, 2),
    }


def iso_dow(column):
    """Day of the week, Monday 1 to Sunday 7."""
    return F.weekday(as_column(column)) + 1


def is_weekend(column):
    return iso_dow(column).isin(6, 7)
