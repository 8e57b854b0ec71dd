"""Text keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from daystar.functions.columns import as_column


def normalise_code(column):
    return F.upper(F.trim(as_column(column)))


def normalise_name(column):
    return F.initcap(as_column(column))


def trimmed(column):
    return F.trim(as_column(column))
