"""Checks on keys, missing values, lengths, ranges and signs. Each returns a DataFrame."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import functions as F

from daystar.operators.lookups import unmatched

__all__ = [
    "both_present",
    "count_by",
    "duplicate_keys",
    "is_empty",
    "key_faults",
    "negatives",
    "null_violations",
    "orphans",
    "profile",
    "too_long",
    "unmatched",
]


def null_violations(df, columns):
    """Rows in which any of `columns` is missing."""
    return df.where(reduce(or_, [F.col(name).isNull() for name in columns]))


def too_long(df, limits):
    """Rows in which any `{column: length}` limit is exceeded."""
    return df.where(reduce(or_, [F.length(name) > size for name, size in limits.items()]))


def negatives(df, columns):
    """Rows in which any of `columns` is below zero."""
    return df.where(reduce(or_, [F.col(name) < 0 for name in columns]))


def duplicate_keys(df, columns):
    """Keys that occur more than once, with their `count`."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("count")).where(F.col("count") > 1)


def orphans(fact, dim, key):
    """Rows of `fact` whose key is not in `dim`."""
    keys = [key] if isinstance(key, str) else list(key)
    return fact.join(dim.select(*keys).distinct(), keys, "left_anti")


def key_faults(tables, parent=None, by=None):
    """`check` and `rows` of several tables, from one scan of each and in one job.

    `tables` is `{name: (frame, key columns)}`. Counted are rows that miss a part of their key,
    keys that occur more than once and, for tables whose key has `by`, rows whose `by` is not in the
    table `parent`. Only key columns are read; rows are counted by key before they are shuffled,
    then by `by`, where the parent's keys meet those of the other tables: no join is needed.
    """
    keys = list(dict.fromkeys(name for _, own in tables.values() for name in own))
    children = [name for name, (_, own) in tables.items() if parent and name != parent and by in own]
    parts = []
    for name, (df, own) in tables.items():
        missing = reduce(or_, [F.col(key).isNull() for key in own])
        parts.append(df.select(F.lit(name).alias("__table"), missing.alias("__missing"), *own))
    rows = reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), parts)
    counted = rows.groupBy("__table", "__missing", *keys).agg(F.count(F.lit(1)).alias("__rows"))
    meet = [by] if parent else []

    def of(name, value):
        return F.coalesce(F.sum(F.when(F.col("__table") == name, value)), F.lit(0))

    sums = {}
    for name in tables:
        sums[f"{name}: missing key"] = of(name, F.when(F.col("__missing"), F.col("__rows")))
        sums[f"{name}: repeated key"] = of(name, (F.col("__rows") > 1).cast("long"))
        if name in children:
            sums[f"{name}: {by} rows"] = of(name, F.col("__rows"))
    known = F.max(F.col("__table") == parent).alias("__known") if parent else F.lit(True).alias("__known")
    met = counted.groupBy(*meet).agg(known, *[value.alias(check) for check, value in sums.items()])
    totals = []
    for check in sums:
        value = F.col(f"`{check}`")
        if check.endswith(f": {by} rows"):
            # A missing key is in no table.
            lost = ~F.col("__known") | F.col(by).isNull()
            value, check = F.when(lost, value), check.replace(f"{by} rows", f"{by.removesuffix('_id')} not in {parent}")
        totals.append(F.struct(F.lit(check).alias("check"), F.coalesce(F.sum(value), F.lit(0)).cast("long").alias("rows")))
    return met.agg(F.array(*totals).alias("all")).select(F.inline("all"))


def profile(df, date="full_date"):
    """First date, last date and number of rows."""
    return df.agg(
        F.min(date).alias("min_date"),
        F.max(date).alias("max_date"),
        F.count(F.lit(1)).alias("rows"),
    )


def count_by(df, key="state_code"):
    """Rows per key, most first; equal counts in key order."""
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy(F.desc_nulls_last("rows"), F.asc_nulls_last(key))
    )


def is_empty(df):
    return df.isEmpty()


def both_present(left, right):
    """Whether neither frame is empty."""
    return not left.isEmpty() and not right.isEmpty()
