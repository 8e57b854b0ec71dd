"""Rows that silver cannot take are kept aside, by the job that writes the others."""

from __future__ import annotations

import pytest

from daystar import contracts
from daystar.plans import pipeline, silver
from daystar.sources import catalog, files, scratch
from daystar.sources.us_states import us_states

CASES = [
    ("2020-05-01", "New York", "1", "0"),
    ("2020-05-02", "New York", "n/a", "x"),
    ("05/03/2020", "New York", "3", "0"),
    ("2020-05-04", "Atlantis", "4", None),
    (None, None, "oops", " "),
    ("2020-05-05", "Texas", " 5.5 ", ""),
]


@pytest.fixture
def base(spark):
    base = scratch.new_folder(spark, "quarantine")
    files.write_csv(spark.createDataFrame(CASES, contracts.BRONZE_CASES), f"{base}/bronze/cases")
    tests = [("20200501", "NY", "1", "1", "0"), ("20200502", "TX", "1", "1", "0")]
    files.write_csv(spark.createDataFrame(tests, contracts.BRONZE_TESTS), f"{base}/bronze/tests")
    files.write_csv(us_states(spark), f"{base}/bronze/static")
    return base


def days(df):
    return sorted(row.full_date.day for row in df.collect())


@pytest.mark.parametrize(
    ("rule", "kept", "reasons"),
    [
        ("keys", [1, 2, 5], {"full_date", "state_code", "full_date,state_code,cases"}),
        ("strict", [1, 5], {"cases,deaths", "full_date", "state_code", "full_date,state_code,cases"}),
    ],
)
def test_kept_and_quarantined_are_all_rows(spark, base, rule, kept, reasons):
    pipeline.build_silver(spark, base, quarantine=rule)
    assert days(pipeline.silver_tables(spark, base)["cases_standardized"]) == kept
    lost = pipeline.quarantined(spark, base, "cases_standardized").collect()
    assert len(kept) + len(lost) == len(CASES)
    assert {",".join(row.faults) for row in lost} == reasons
    assert next(row.raw.date for row in lost if list(row.faults) == ["full_date"]) == "05/03/2020"
    # Of a feed without faults nothing is put aside.
    assert pipeline.quarantined(spark, base, "testing_standardized").count() == 0
    assert pipeline.silver_tables(spark, base)["testing_standardized"].count() == 2


def test_quarantine_changes_no_result(spark, base):
    plain, checked = {}, {}
    for found, rule in ((plain, None), (checked, "keys")):
        catalog.ensure_databases(spark, "quarantine_test", f"{base}/databases")
        gold = pipeline.run(spark, base, prefix="quarantine_test", quarantine=rule, least_rows=0)
        found |= {name: sorted(map(tuple, df.collect()), key=str) for name, df in gold.items()}
        found["registered"] = spark.table("quarantine_test_silver.cases_standardized").count()
    assert plain == checked and plain["registered"] == 3


def test_everything_may_be_quarantined(spark, base):
    files.write_csv(
        spark.createDataFrame([("x", "y", "1", "1")], contracts.BRONZE_CASES), f"{base}/bronze/cases"
    )
    pipeline.build_silver(spark, base, quarantine="keys")
    assert pipeline.silver_tables(spark, base)["cases_standardized"].count() == 0
    assert pipeline.quarantined(spark, base, "cases_standardized").count() == 1


def test_checked_rows_carry_their_faults(spark, frame):
    lookup = frame("state_code string, state_name string", ("NY", "New York"))
    raw = spark.createDataFrame(CASES, contracts.BRONZE_CASES)
    rows = silver.checked_cases(raw, lookup).collect()
    assert sum(row.status == "kept" and list(row.faults) == ["cases", "deaths"] for row in rows) == 1
    assert all((row.raw is None) == (row.status == "kept") for row in rows)
