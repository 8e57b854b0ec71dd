"""Date and region dimensions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daystar.contracts import DIM_DATE
from daystar.functions import date_key, date_parts, is_weekend, iso_dow


def union_dates(*frames, date="full_date"):
    """Every date that occurs in any of `frames`, once."""
    return reduce(DataFrame.unionByName, [df.select(date) for df in frames]).dropDuplicates()


def dim_date(*frames, date="full_date"):
    """Date dimension over all dates of `frames`."""
    dates = union_dates(*frames, date=date).withColumnRenamed(date, "full_date")
    return dates.withColumns(
        {
            "date_id": date_key("full_date"),
            **date_parts("full_date"),
            "dow": iso_dow("full_date"),
            "is_weekend": is_weekend("full_date"),
        }
    ).select(*DIM_DATE.fieldNames())


def dim_date_simple(silver):
    """Date dimension of text-keyed silver: key and parts, in key order."""
    return silver.select("date_id", "year", "month", "day").distinct().orderBy(
        F.asc_nulls_last("date_id")
    )


def dim_region(silver):
    """Every region code and name of `silver`, once."""
    return silver.select("state_code", "state_name").dropDuplicates()


def region_codes(silver):
    """Every region code of `silver`, once, in order."""
    return silver.select("state_code").distinct().orderBy(F.asc_nulls_last("state_code"))
