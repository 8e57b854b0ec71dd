from __future__ import annotations

import pytest

from daystar.operators import lookups, quality
from daystar.sources.us_states import us_states


@pytest.fixture
def states(spark):
    return lookups.region_lookup(us_states(spark))


def test_built_in_lookup(spark, states):
    assert us_states(spark).count() == 51
    assert quality.is_empty(quality.duplicate_keys(states, ["state_code"]))
    assert ("DC", "District Of Columbia") in [tuple(row) for row in states.collect()]


def test_by_name_folds_case(frame, states):
    raw = frame("state string", "new york", "district of columbia", "Puerto Rico", None)
    found = {r.state: r.state_code for r in lookups.attach_region_by_name(raw, states).collect()}
    assert found == {"new york": "NY", "district of columbia": "DC", "Puerto Rico": None, None: None}
    exact = lookups.attach_region_by_name(raw, states, match="exact").collect()
    assert {row.state_code for row in exact} == {None}


def test_by_code_trimmed(frame):
    regions = frame("state_code string, state_name string", (" NY", "New York"), (None, "None"))
    feed = frame("state string, cases int", ("NY ", 1), ("TX", 2), (None, 3))
    rows = lookups.attach_region_by_code(feed, regions, code="state", match="trim").collect()
    assert sorted(map(tuple, rows), key=str) == [
        ("NY ", 1, "New York"), ("TX", 2, None), (None, 3, None)
    ]


def test_duplicate_lookup_names_do_not_multiply_rows(frame):
    lookup = frame("state_code string, state_name string", ("Z", "Same"), ("A", "Same"))
    raw = frame("state string", "same")
    assert [tuple(r) for r in lookups.attach_region_by_name(raw, lookup).collect()] == [
        ("same", "A", "Same")
    ]
    assert [tuple(r) for r in lookups.pick_regions(lookup, ["Same"]).collect()] == [("Same", "A")]


def test_unmatched(frame, states):
    raw = frame("state string", "Guam", "Guam", "new york", None)
    rows = {row.state: row.rows for row in lookups.unmatched(raw, states).collect()}
    assert rows == {"Guam": 2, None: 1}


def test_checks(frame):
    df = frame("k string, n int", ("a", 1), ("a", -1), (None, None), ("long", 2))
    rows = lambda checked: sorted(map(tuple, checked.collect()), key=str)
    assert rows(quality.null_violations(df, ["k", "n"])) == [(None, None)]
    assert rows(quality.too_long(df, {"k": 2})) == [("long", 2)]
    assert rows(quality.negatives(df, ["n"])) == [("a", -1)]
    assert rows(quality.duplicate_keys(df, ["k"])) == [("a", 2)]
    dim = frame("k string", "a")
    assert rows(quality.orphans(df, dim, "k")) == [("long", 2), (None, None)]
    assert rows(lookups.require(df, ["k"])) == [("a", -1), ("a", 1), ("long", 2)]
    assert quality.both_present(df, dim) and not quality.both_present(df, dim.limit(0))
    counted = [tuple(row) for row in quality.count_by(df, "k").collect()]
    assert counted == [("a", 2), ("long", 1), (None, 1)]
