"""Daily facts: cumulative counters with their day-over-day changes."""

from __future__ import annotations

from daystar.contracts import FACT_CASES, FACT_FEED, FACT_TESTING
from daystar.functions import date_key, percent, ratio
from daystar.operators.lookups import attach_region_by_code
from daystar.operators.series import HOT_ROWS, daily_delta


def cases(silver, clamp=True, text_key=False, hot_rows=HOT_ROWS, before=None):
    """Cases fact, one row per row of `silver`.

    Rows without a code are kept. Where silver carries the name too, each name without a
    code is a series of its own; without names they are one series. `before` is the tail of
    the rows of earlier days, where `silver` holds later ones only.
    """
    suffix = "" if text_key else "_cum"
    columns = {"new_cases": f"cases{suffix}", "new_deaths": f"deaths{suffix}"}
    fact = _with_deltas(silver, columns, clamp, text_key, hot_rows, before)
    if text_key:
        return fact.select("date_id", "state_code", "cases", "deaths", "new_cases", "new_deaths")
    return fact.select(*FACT_CASES.fieldNames())


def testing(
    silver,
    clamp=True,
    text_key=False,
    as_percent=False,
    decimals=2,
    hot_rows=HOT_ROWS,
    before=None,
):
    """Testing fact. Positivity is a fraction, or a rounded percentage under `as_percent`."""
    total, positive, negative = (
        ("tests_total", "tests_positive", "tests_negative")
        if text_key
        else ("tests_total_cum", "tests_pos_cum", "tests_neg_cum")
    )
    fact = _with_deltas(silver, {"new_tests": total}, clamp, text_key, hot_rows, before)
    rate = percent(positive, total, decimals) if as_percent else ratio(positive, total)
    fact = fact.withColumn("positivity_rate", rate)
    if text_key:
        return fact.select(
            "date_id", "state_code", total, positive, negative, "new_tests", "positivity_rate"
        )
    return fact.select(*FACT_TESTING.fieldNames())


def denormalised(feed, regions):
    """Feed that already carries daily changes, with the region name in place of its code."""
    named = attach_region_by_code(feed, regions, code="state", match="trim")
    return named.select(*FACT_FEED.fieldNames())


def series_of(silver, columns, text_key=False):
    """(keys, order) of the series that the changes of the counters `columns` are taken in."""
    keys = [name for name in ("state_code", "state_name") if name in silver.columns]
    if not text_key:
        # A typed row always has a code, and its name follows from it.
        keys = ["state_code"]
    # Repeated dates come in the order of their counters, so reruns agree.
    return keys, ["date_id" if text_key else "full_date", *dict.fromkeys(columns)]


def _with_deltas(silver, columns, clamp, text_key, hot_rows, before):
    keys, order = series_of(silver, columns.values(), text_key)
    fact = daily_delta(silver, columns, keys, order, clamp, hot_rows, before)
    return fact if text_key else fact.withColumn("date_id", date_key("full_date"))
