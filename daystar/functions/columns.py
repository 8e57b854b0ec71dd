from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(column):
    return column if isinstance(column, Column) else F.col(column)
