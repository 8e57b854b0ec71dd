"""Bronze feeds to typed silver tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from daystar.contracts import (
    SILVER_CASES,
    SILVER_CASES_TEXT_KEY,
    SILVER_FEED,
    SILVER_TESTS,
    SILVER_TESTS_TEXT_KEY,
)
from daystar.functions import (
    compact_date,
    date_key_parts,
    date_key_text,
    date_parts,
    iso_date,
    lenient_long,
    normalise_code,
    strict_long,
)
from daystar.functions.columns import as_column
from daystar.operators.lookups import attach_region_by_code, attach_region_by_name, require

# Text-keyed cases with the name that the feed gives.
NAMED_CASES_TEXT_KEY = StructType(
    [*SILVER_CASES_TEXT_KEY.fields, StructField("state_name", StringType())]
)


_RAW = "__raw"


def standardize_cases(
    raw,
    lookup,
    keep_unmatched=False,
    text_key=False,
    match="initcap",
    keep_name=False,
    keep_all=False,
):
    """Typed cases, with the region found by name.

    Regions missing from the lookup are dropped, or kept without a code under
    `keep_unmatched`. `text_key` keeps the date as `yyyyMMdd` text, and with
    `keep_name` the name as it came, which tells regions without a code apart. `keep_all`
    drops no row and no column.
    """
    attached = attach_region_by_name(raw, lookup, match=match)
    if text_key:
        typed = attached.withColumns(
            {
                "date_id": date_key_text("date"),
                "cases": lenient_long("cases"),
                "deaths": lenient_long("deaths"),
            }
        )
        typed = typed.withColumns(_whole_parts("date_id"))
        contract, required = SILVER_CASES_TEXT_KEY, ["date_id"]
    else:
        typed = attached.withColumns(
            {
                "full_date": iso_date("date"),
                "cases_cum": lenient_long("cases"),
                "deaths_cum": lenient_long("deaths"),
            }
        )
        typed = typed.withColumns(date_parts("full_date"))
        if keep_all:
            return typed
        contract, required = SILVER_CASES, ["full_date"]
    if keep_unmatched:
        # The text key form keeps every row; a typed date is always required.
        required = [] if text_key else required
    else:
        required = [*required, "state_code"]
    if text_key and keep_name:
        typed, contract = typed.withColumn("state_name", as_column("state")), NAMED_CASES_TEXT_KEY
    return _shaped(typed, contract, required)


def standardize_tests(raw, lookup=None, text_key=False, keep_all=False):
    """Typed tests, with the region name found by code; a code without a name stays.

    `text_key` keeps date and code as they came, joins nothing and drops nothing. `keep_all`
    drops no row and no column.
    """
    if text_key:
        typed = raw.withColumns(
            {
                "date_id": as_column("date").cast("string"),
                "state_code": as_column("state"),
                "tests_total": lenient_long("totalTestResults"),
                "tests_positive": lenient_long("positive"),
                "tests_negative": lenient_long("negative"),
            }
        )
        typed = typed.withColumns(_whole_parts("date_id"))
        return _shaped(typed, SILVER_TESTS_TEXT_KEY, [])
    typed = raw.withColumns(
        {
            "full_date": compact_date("date"),
            "state_code": normalise_code("state"),
            "tests_total_cum": lenient_long("totalTestResults"),
            "tests_pos_cum": lenient_long("positive"),
            "tests_neg_cum": lenient_long("negative"),
        }
    )
    typed = typed.withColumns(date_parts("full_date"))
    named = attach_region_by_code(typed, lookup)
    if keep_all:
        return named
    return _shaped(named, SILVER_TESTS, ["full_date", "state_code"])


def checked_cases(raw, lookup, strict=False):
    """Every row of a cases feed, either kept or quarantined; see `_checked`."""
    typed = standardize_cases(_with_raw(raw), lookup, keep_all=True)
    counters = {"cases": "cases_cum", "deaths": "deaths_cum"}
    return _checked(typed, SILVER_CASES, ["full_date", "state_code"], counters, strict)


def checked_tests(raw, lookup, strict=False):
    """Every row of a tests feed, either kept or quarantined; see `_checked`."""
    typed = standardize_tests(_with_raw(raw), lookup, keep_all=True)
    counters = {
        "totalTestResults": "tests_total_cum", "positive": "tests_pos_cum", "negative": "tests_neg_cum"
    }
    return _checked(typed, SILVER_TESTS, ["full_date", "state_code"], counters, strict)


def _with_raw(raw):
    return raw.withColumn(_RAW, F.struct("*"))


def _checked(typed, contract, required, counters, strict):
    """The contract's columns, `status`, `faults` and `raw`, one row per row of the feed.

    A row without a required key is `quarantined`, and under `strict` one with a counter that
    is there but no number; all others are `kept`. `faults` names the keys that are missing and the
    counters that cannot be read, of kept rows too; `raw` is the row as it came, of quarantined ones.
    """
    missing = [F.when(F.col(name).isNull(), F.lit(name)) for name in required]
    unreadable = [
        F.when(F.col(column).isNull() & (F.trim(F.col(_RAW)[name]) != ""), F.lit(name))
        for name, column in counters.items()
    ]
    faults = F.array_compact(F.array(*missing, *unreadable))
    reasons = faults if strict else F.array_compact(F.array(*missing))
    lost = F.size(reasons) > 0
    return typed.select(
        *contract.fieldNames(),
        F.when(lost, F.lit("quarantined")).otherwise(F.lit("kept")).alias("status"),
        faults.alias("faults"),
        F.when(lost, F.col(_RAW)).alias("raw"),
    )


def typed_copy(raw):
    """Feed that already carries daily changes: same columns, counters strictly parsed."""
    counters = ["cases", "deaths", "new_cases", "new_deaths"]
    typed = raw.withColumns({name: strict_long(name) for name in counters})
    return _shaped(typed, SILVER_FEED, [])


def _whole_parts(key):
    # Whole numbers from the start: a partitioned read would turn text into them.
    return {name: part.try_cast("int") for name, part in date_key_parts(key).items()}


def _shaped(df, contract, required):
    shaped = df.select(*contract.fieldNames())
    return require(shaped, required) if required else shaped
