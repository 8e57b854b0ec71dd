"""Ready answers on the star: trends, top regions, cases against tests, totals.

`lookup` is a cleaned lookup with `state_code` and `state_name`. Every mart is one
lazy DataFrame.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from daystar.functions import compact_date, date_label, iso_date, ratio
from daystar.operators.lookups import attach_region_by_code, pick_regions
from daystar.operators.series import HOT_ROWS, first_n, moving_avg

# Fixed value: rows of a region that a dashboard page shows; no trend is cut unless asked.
TREND_ROWS = 500


def trends(
    fact, lookup, measures, averaged, names=None, regions=None, limit=None, hot_rows=HOT_ROWS
):
    """Measures per region and day, with 7-row averages of the `averaged` ones.

    `names` or `regions` (codes) pick regions; all of the lookup by default. With a
    `limit` only the first rows of a region count, in date order, and averages are
    taken over those. Names that share a code each have the code's series.
    """
    picks = pick_regions(lookup, names)
    if regions is not None:
        codes = list(regions)
        fact = filter_regions(fact, codes)
        picks = picks.where(F.col("state_code").isin(codes))
    return _trend(fact, picks, measures, averaged, limit, hot_rows, bounded=names is not None)


def cases_trend(fact, lookup, names=None, **options):
    measures = ["new_cases", "new_deaths"]
    return trends(fact, lookup, measures, measures, names, **options)


def testing_trend(fact, lookup, names=None, **options):
    measures = ["new_tests", "positivity_rate"]
    return trends(fact, lookup, measures, measures, names, **options)


def combined(cases, tests, lookup, names=None, limit=None, hot_rows=HOT_ROWS):
    """Cases trend and testing trend of the regions that have rows in both facts."""
    picks = pick_regions(lookup, names)
    for fact in (cases, tests):
        picks = picks.join(fact.select("state_code").distinct(), "state_code", "left_semi")
    shared = {"limit": limit, "hot_rows": hot_rows, "bounded": names is not None}
    rates = ["new_tests", "positivity_rate"]
    return (
        _trend(cases, picks, ["new_cases", "new_deaths"], ["new_cases"], **shared),
        _trend(tests, picks, rates, rates, **shared),
    )


def resolve_regions(fact, lookup, names=None):
    """Rows of the picked regions, with `state_name` added."""
    return _of_regions(fact, pick_regions(lookup, names), bounded=names is not None)


def filter_region(fact, region):
    return fact.where(F.col("state_code") == region)


def filter_regions(fact, regions):
    return fact.where(F.col("state_code").isin(list(regions)))


def filter_date(fact, date_id):
    """Rows of one date. A text key is compared as text, so any text may be among its values."""
    text = isinstance(fact.schema["date_id"].dataType, StringType)
    return fact.where(F.col("date_id") == F.lit(str(date_id) if text else int(date_id)))


def top_n_on_date(fact, lookup, date_id, metric="new_cases", n=5):
    """The `n` regions with the highest `metric` on a date; ties in code order."""
    return (
        attach_region_by_code(filter_date(fact, date_id), lookup, how="inner")
        .select("state_code", "state_name", metric)
        .orderBy(F.desc_nulls_last(metric), F.asc_nulls_last("state_code"))
        .limit(n)
    )


def positivity_trend(tests, dim_date, region):
    """Positivity of a region by date."""
    return (
        filter_region(tests, region)
        .join(dim_date.select("date_id", "full_date"), "date_id")
        .select("full_date", _positivity())
        .orderBy(F.asc_nulls_last("full_date"))
    )


def cases_vs_tests(cases, tests, dim_date, region=None):
    """New cases, new tests and positivity by date, of one region or by region."""
    if region is not None:
        cases, tests = filter_region(cases, region), filter_region(tests, region)
    shown = ["full_date"] if region is not None else ["state_code", "full_date"]
    return (
        cases.select("date_id", "state_code", "new_cases")
        .join(
            tests.select("date_id", "state_code", "new_tests", "tests_pos_cum", "tests_total_cum"),
            ["date_id", "state_code"],
        )
        .join(dim_date.select("date_id", "full_date"), "date_id")
        .select(*shown, "new_cases", "new_tests", _positivity())
        .orderBy(*[F.asc_nulls_last(name) for name in shown])
    )


def daily_total(fact, date="date", value="new_cases"):
    """Sum of `value` by date; rows without a date are left out."""
    return (
        fact.where(F.col(date).isNotNull())
        .groupBy(date)
        .agg(F.coalesce(F.sum(value), F.lit(0)).alias(value))
        .orderBy(date)
    )


def top_regions_total(fact, n=10, mode="latest", name="state_name", value="cases", date="date"):
    """The `n` regions with the highest total.

    `value` is cumulative, so the total is its latest reported value. The mode
    `sum_cumulative` adds up all values instead, as older reports did.
    """
    if mode == "latest":
        known = fact.where(F.col(value).isNotNull())
        # Of several rows on the latest date the highest value counts.
        total = F.max_by(value, F.struct(iso_date(date), F.col(value)))
    elif mode == "sum_cumulative":
        known, total = fact, F.coalesce(F.sum(value), F.lit(0))
    else:
        raise ValueError(f"unknown mode: {mode!r}")
    return (
        known.where(F.col(name).isNotNull())
        .groupBy(name)
        .agg(total.alias(value))
        .orderBy(F.desc_nulls_last(value), F.asc(name))
        .limit(n)
    )


def preview(table, n=10, key="date_id"):
    """The first `n` rows in key order."""
    return table.orderBy(F.asc_nulls_last(key)).limit(n)


def region_list(lookup):
    """Codes and names to pick from, in name order."""
    return lookup.select("state_code", "state_name").orderBy(
        F.asc_nulls_last("state_name"), F.asc_nulls_last("state_code")
    )


def _of_regions(fact, picks, bounded):
    # A list of names gives at most one row each, so that side is always small.
    # Without one the planner checks the size of the lookup.
    return fact.join(F.broadcast(picks) if bounded else picks, "state_code")


def _trend(fact, picks, measures, averaged, limit, hot_rows, bounded):
    rows = _of_regions(fact.select("date_id", "state_code", *measures), picks, bounded)
    key, order = ["state_code", "state_name"], ["date_id"]
    if limit is not None:
        rows = first_n(rows, key, order, limit)
        # What is left of a series is known to be short.
        hot_rows = None if limit <= HOT_ROWS else hot_rows
    averages = {f"{name}_7day": name for name in averaged}
    rows = moving_avg(rows, averages, key, order, rows=7, hot_rows=hot_rows)
    return rows.select(
        date_label(compact_date("date_id")).alias("date"),
        "state_code",
        "state_name",
        *measures,
        *averages,
    )


def _positivity():
    rate = ratio("tests_pos_cum", "tests_total_cum", guard="nonzero")
    return rate.alias("positivity_rate")
