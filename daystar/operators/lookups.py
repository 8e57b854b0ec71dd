"""Region lookups and the joins to them.

No join carries a broadcast hint: the planner broadcasts a lookup whose size it
has checked against the session's threshold, and shuffles a larger one, with the
adaptive skew join splitting a hot region.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from daystar.functions import normalise_code, normalise_name, trimmed
from daystar.functions.columns import as_column

# How two text keys are compared.
MATCHES = {"initcap": normalise_name, "trim": trimmed, "exact": as_column}


def region_lookup(raw):
    """Cleaned lookup: upper-case trimmed code, capitalised name."""
    return raw.select(
        normalise_code("abbr").alias("state_code"), normalise_name("name").alias("state_name")
    )


def attach_region_by_name(df, lookup, name="state", match="initcap", how="left"):
    """Add `state_code` and `state_name` of the lookup row with the same name."""
    return _attach(df, lookup, name, "state_name", ["state_code", "state_name"], match, how)


def attach_region_by_code(df, lookup, code="state_code", match="exact", how="left"):
    """Add the `state_name` of the lookup row with the same code."""
    return _attach(df, lookup, code, "state_code", ["state_name"], match, how)


def pick_regions(lookup, names=None):
    """One `state_code, state_name` row per picked name, or per name of the lookup.

    Of several codes for a name the first in order is taken.
    """
    picked = lookup if names is None else lookup.where(F.col("state_name").isin(list(names)))
    return picked.groupBy("state_name").agg(F.min("state_code").alias("state_code"))


def require(df, columns):
    """Rows in which all `columns` are present."""
    return df.dropna(subset=list(columns))


def unmatched(raw, lookup, name="state", match="initcap"):
    """Names without a lookup row, with the number of rows that carry them."""
    fold, key = MATCHES[match], "__key"
    # Counted first: the join then sees each name once, however often it occurs.
    names = raw.groupBy(name).agg(F.count(F.lit(1)).alias("rows")).withColumn(key, fold(name))
    known = lookup.select(fold("state_name").alias(key)).distinct()
    return names.join(known, key, "left_anti").drop(key)


def _attach(df, lookup, left, right, take, match, how):
    fold, key, row = MATCHES[match], "__key", "__row"
    # One lookup row per key, so that no row of `df` is multiplied.
    slim = (
        lookup.select(fold(right).alias(key), F.struct(*take).alias(row))
        .groupBy(key)
        .agg(F.min(row).alias(row))
    )
    return (
        df.withColumn(key, fold(left))
        .join(slim, key, how)
        .select(*df.columns, *[F.col(f"{row}.{name}").alias(name) for name in take])
    )
