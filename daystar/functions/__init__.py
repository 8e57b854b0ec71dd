"""Column helpers. Each takes column names or Columns and returns a Column."""

from daystar.functions.casts import lenient_long, strict_long
from daystar.functions.dates import (
    compact_date,
    date_key,
    date_key_parts,
    date_key_text,
    date_label,
    date_parts,
    is_weekend,
    iso_date,
    iso_dow,
)
from daystar.functions.numbers import percent, ratio
from daystar.functions.text import normalise_code, normalise_name, trimmed

__all__ = [
    "compact_date",
    "date_key",
    "date_key_parts",
    "date_key_text",
    "date_label",
    "date_parts",
    "is_weekend",
    "iso_date",
    "iso_dow",
    "lenient_long",
    "normalise_code",
    "normalise_name",
    "percent",
    "ratio",
    "strict_long",
    "trimmed",
]
