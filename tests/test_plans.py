from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from daystar import contracts
from daystar.operators import lookups
from daystar.plans import dims, facts, marts, publish, silver
from daystar.sources.us_states import us_states

MAY_1 = date(2020, 5, 1)


@pytest.fixture
def states(spark):
    return lookups.region_lookup(us_states(spark))


@pytest.fixture
def raw_cases(frame):
    return frame(
        "date string, state string, cases string, deaths string",
        ("2020-05-01", "new york", "10", "1.0"),
        ("2020-05-02", "New York", "8", ""),
        ("2020-05-03", "NEW YORK", "12", "3"),
        ("2020-05-01", "Puerto Rico", "5", "0"),
        ("2020-13-01", "New York", "1", "1"),
    )


@pytest.fixture
def raw_tests(frame):
    return frame(
        "date string, state string, totalTestResults string, positive string, negative string",
        ("20200501", " ny", "100", "10", "90"),
        ("20200502", "NY", "300", "20.0", "x"),
        ("20200501", "PR", "0", "0", "0"),
        ("20201301", "NY", "1", "1", "1"),
        ("20200501", None, "1", "1", "1"),
    )


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_silver_cases(raw_cases, states, ansi):
    df = silver.standardize_cases(raw_cases, states)
    assert df.schema.fieldNames() == contracts.SILVER_CASES.fieldNames()
    assert [f.dataType for f in df.schema] == [f.dataType for f in contracts.SILVER_CASES]
    assert rows(df) == [
        (MAY_1, "NY", "New York", 10, 1, 2020, 5, 1),
        (date(2020, 5, 2), "NY", "New York", 8, None, 2020, 5, 2),
        (date(2020, 5, 3), "NY", "New York", 12, 3, 2020, 5, 3),
    ]
    kept = silver.standardize_cases(raw_cases, states, keep_unmatched=True)
    assert (MAY_1, None, None, 5, 0, 2020, 5, 1) in rows(kept) and kept.count() == 4


def test_silver_cases_text_key(raw_cases, spark, ansi):
    lookup = us_states(spark).selectExpr("abbr AS state_code", "name AS state_name")
    df = silver.standardize_cases(
        raw_cases, lookup, keep_unmatched=True, text_key=True, match="exact"
    )
    assert [f.dataType for f in df.schema] == [f.dataType for f in contracts.SILVER_CASES_TEXT_KEY]
    assert rows(df) == sorted(
        [
            ("20200501", None, 10, 1, 2020, 5, 1),
            ("20200502", "NY", 8, None, 2020, 5, 2),
            ("20200503", None, 12, 3, 2020, 5, 3),
            ("20200501", None, 5, 0, 2020, 5, 1),
            ("20201301", "NY", 1, 1, 2020, 13, 1),
        ],
        key=str,
    )


def test_silver_tests(raw_tests, states, ansi):
    df = silver.standardize_tests(raw_tests, states)
    assert [f.dataType for f in df.schema] == [f.dataType for f in contracts.SILVER_TESTS]
    assert rows(df) == [
        (MAY_1, "NY", "New York", 100, 10, 90, 2020, 5, 1),
        (MAY_1, "PR", None, 0, 0, 0, 2020, 5, 1),
        (date(2020, 5, 2), "NY", "New York", 300, 20, None, 2020, 5, 2),
    ]
    assert silver.standardize_tests(raw_tests, text_key=True).count() == 5


def test_typed_copy_is_strict(frame, ansi):
    feed = frame(contracts.BRONZE_FEED, ("2020-05-01", "NY", "1", "2.0", "", "x"))
    assert rows(silver.typed_copy(feed)) == [("2020-05-01", "NY", 1, None, None, None)]


def test_facts(raw_cases, raw_tests, states):
    fact = facts.cases(silver.standardize_cases(raw_cases, states))
    assert rows(fact) == [
        (20200501, "NY", 10, 1, 0, 0),
        (20200502, "NY", 8, None, 0, 0),
        (20200503, "NY", 12, 3, 4, 0),
    ]
    signed = facts.cases(silver.standardize_cases(raw_cases, states), clamp=False)
    assert [row[4] for row in rows(signed)] == [0, -2, 4]
    tests = facts.testing(silver.standardize_tests(raw_tests, states))
    assert rows(tests) == [
        (20200501, "NY", 100, 10, 90, 0, 0.1),
        (20200501, "PR", 0, 0, 0, 0, None),
        (20200502, "NY", 300, 20, None, 200, 20 / 300),
    ]
    percent = facts.testing(silver.standardize_tests(raw_tests, states), as_percent=True)
    assert [row[6] for row in rows(percent)] == [10.0, None, 6.67]


def test_regions_without_code_do_not_share_a_series(frame):
    text = frame(
        "date_id string, state_code string, state_name string, cases bigint, deaths bigint",
        ("20200501", None, "Guam", 5, 0), ("20200502", None, "Guam", 7, 0),
        ("20200502", None, "Puerto Rico", 900, 0), ("20200501", "NY", "New York", 1, 0),
    )
    found = facts.cases(text, clamp=False, text_key=True).collect()
    assert sorted((r.date_id, r.state_code or "", r.cases, r.new_cases) for r in found) == [
        ("20200501", "", 5, 0), ("20200501", "NY", 1, 0), ("20200502", "", 7, 2), ("20200502", "", 900, 0),
    ]


def test_names_that_share_a_code_have_series_of_their_own(frame):
    fact = frame(
        "date_id int, state_code string, new_cases bigint, new_deaths bigint",
        *[(20200501 + day, "NY", 10 * day, 0) for day in range(9)],
    )
    lookup = frame("state_code string, state_name string", ("NY", "New York"), ("NY", "New York State"))
    both = marts.cases_trend(fact, lookup)
    for name in ("New York", "New York State"):
        alone = marts.cases_trend(fact, lookup, names=[name])
        assert rows(both.where(F.col("state_name") == name)) == rows(alone)
    assert both.count() == 18


def test_dims(raw_cases, raw_tests, states, frame):
    cases = silver.standardize_cases(raw_cases, states)
    tests = silver.standardize_tests(raw_tests, states)
    dim = dims.dim_date(cases, tests)
    assert rows(dim) == [
        (20200501, MAY_1, 2020, 5, 1, 5, False),
        (20200502, date(2020, 5, 2), 2020, 5, 2, 6, True),
        (20200503, date(2020, 5, 3), 2020, 5, 3, 7, True),
    ]
    assert rows(dims.dim_region(cases)) == [("NY", "New York")]
    text = frame(contracts.SILVER_CASES_TEXT_KEY, ("20200501", None, 1, 1, 2020, 5, 1))
    assert rows(dims.dim_date_simple(text)) == [("20200501", 2020, 5, 1)]
    assert rows(dims.region_codes(text)) == [(None,)]


@pytest.fixture
def fact(frame):
    rows_ = [(20200500 + d, code, d * k, 0) for k, code in [(1, "NY"), (2, "TX")] for d in range(1, 10)]
    return frame("date_id int, state_code string, new_cases bigint, new_deaths bigint", *rows_)


def test_cases_trend(fact, states):
    df = marts.cases_trend(fact, states, names=["Texas", "Ohio"])
    shown = df.orderBy("date").collect()
    assert df.columns == [
        "date", "state_code", "state_name", "new_cases", "new_deaths",
        "new_cases_7day", "new_deaths_7day",
    ]
    assert [r.date for r in shown] == [f"2020-05-0{d}" for d in range(1, 10)]
    assert [r.new_cases_7day for r in shown] == [None] * 6 + [8.0, 10.0, 12.0]
    assert {r.state_name for r in shown} == {"Texas"}
    assert marts.cases_trend(fact, states, limit=3).count() == 6
    assert marts.cases_trend(fact, states, limit=None).count() == 18
    assert marts.cases_trend(fact, states, regions=["NY"]).count() == 9


def test_combined_needs_both_sides(fact, states, frame):
    tests = frame(
        "date_id int, state_code string, new_tests bigint, positivity_rate double",
        (20200501, "TX", 1, 0.5), (20200501, "OH", 1, 0.5),
    )
    names = ["Texas", "New York", "Ohio"]
    cases_side, tests_side = marts.combined(fact, tests, states, names)
    assert cases_side.count() == 9 and tests_side.count() == 1
    assert cases_side.columns[-1] == "new_cases_7day" and "new_deaths" in cases_side.columns
    assert {r.state_code for r in cases_side.union(cases_side).collect()} == {"TX"}


def test_top_n_breaks_ties_by_code(frame, states):
    fact_ = frame(
        "date_id int, state_code string, new_cases bigint",
        (20200501, "TX", 66), (20200501, "NY", 66), (20200501, "CA", 70),
        (20200501, "OH", None), (20200502, "FL", 900), (20200501, "PR", 999),
    )
    top = [tuple(row) for row in marts.top_n_on_date(fact_, states, "20200501", n=3).collect()]
    assert top == [("CA", "California", 70), ("NY", "New York", 66), ("TX", "Texas", 66)]
    everything = marts.top_n_on_date(fact_, states, 20200501).collect()
    assert [r.state_code for r in everything] == ["CA", "NY", "TX", "OH"]


def test_totals(frame):
    feed = frame(
        contracts.FACT_FEED,
        ("2020-05-01", "New York", 5, 0, None, 0),
        ("2020-05-02", "New York", 9, 0, None, 0),
        ("2020-05-03", "New York", None, 0, 4, 0),
        ("2020-05-03", "Texas", 7, 0, 2, 0),
        (None, "Texas", 1, 0, 50, 0),
        ("2020-05-02", None, 100, 0, None, 0),
    )
    daily = [tuple(row) for row in marts.daily_total(feed).collect()]
    assert daily == [("2020-05-01", 0), ("2020-05-02", 0), ("2020-05-03", 6)]
    latest = [tuple(row) for row in marts.top_regions_total(feed).collect()]
    assert latest == [("New York", 9), ("Texas", 7)]
    summed = marts.top_regions_total(feed, n=1, mode="sum_cumulative").collect()
    assert [tuple(row) for row in summed] == [("New York", 14)]
    with pytest.raises(ValueError):
        marts.top_regions_total(feed, mode="other")


def test_positivity_and_cases_vs_tests(frame):
    tests = frame(
        contracts.FACT_TESTING,
        (20200501, "NY", 10, 5, 5, 0, 0.5), (20200502, "NY", 0, 5, 5, 0, None),
        (20200503, "NY", -1, 5, 5, 0, None), (20200501, "TX", 10, 1, 9, 0, 0.1),
    )
    cases = frame(contracts.FACT_CASES, (20200501, "NY", 1, 1, 3, 0), (20200502, "TX", 1, 1, 9, 0))
    dim = frame("date_id int, full_date date", *[(20200500 + d, date(2020, 5, d)) for d in (1, 2, 3)])
    trend = [tuple(row) for row in marts.positivity_trend(tests, dim, "NY").collect()]
    assert trend == [(MAY_1, 0.5), (date(2020, 5, 2), None), (date(2020, 5, 3), -5.0)]
    both = [tuple(row) for row in marts.cases_vs_tests(cases, tests, dim, "NY").collect()]
    assert both == [(MAY_1, 3, 0, 0.5)]
    assert marts.cases_vs_tests(cases, tests, dim).columns[0] == "state_code"


def test_previews_and_lists(frame, states):
    dim = frame("date_id int", *range(30, 0, -1))
    assert [row[0] for row in marts.preview(dim, 3).collect()] == [1, 2, 3]
    assert marts.region_list(states).first().state_name == "Alabama"


def test_narrow(frame):
    star = contracts.published_star()
    fact_ = frame(contracts.FACT_CASES, (20200501, "NY", 1, 2, 3, 4))
    narrow = publish.narrow(fact_, star["fact_cases_state_daily"])
    assert dict(narrow.dtypes)["new_cases"] == "int" and rows(narrow) == [
        (20200501, "NY", 1, 2, 3, 4)
    ]
    for bad in [(20200501, "NYC", 1, 2, 3, 4), (20200501, "NY", 1, 2, 2**31, 4), (1, None, 1, 2, 3, 4)]:
        with pytest.raises(Exception, match="state_code|new_cases"):
            wrong = frame(contracts.FACT_CASES, bad)
            publish.narrow(wrong, star["fact_cases_state_daily"]).collect()
    assert rows(publish.layout(fact_)) == rows(fact_)
