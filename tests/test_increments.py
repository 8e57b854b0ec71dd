"""Appended days give what a full rebuild gives, without reading what is there."""

from __future__ import annotations

import pytest

from daystar import contracts
from daystar.operators import series
from daystar.plans import increments, pipeline
from daystar.sources import catalog, files, scratch
from daystar.sources.us_states import us_states

DAYS = [f"2020-05-{day:02d}" for day in range(1, 15)]
STATES = [("New York", "NY"), ("Texas", "TX"), ("Ohio", "OH")]


def write_feeds(spark, folder, first, last):
    """Days first to last, counters that rise and fall; Ohio begins late and Texas pauses."""
    cases, tests = [], []
    for number, (name, code) in enumerate(STATES):
        for i in range(first, last):
            if (code == "OH" and i < 9) or (code == "TX" and 6 <= i < 10):
                continue
            cases.append((DAYS[i], name, str(100 + 7 * i - (i % 4) * 9 + number), str(i)))
            tests.append((DAYS[i].replace("-", ""), code, str(50 * i - (i % 3) * 60), str(i), str(40 * i)))
    files.write_csv(spark.createDataFrame(cases, contracts.BRONZE_CASES), f"{folder}/cases")
    files.write_csv(spark.createDataFrame(tests, contracts.BRONZE_TESTS), f"{folder}/tests")


@pytest.fixture
def base(spark):
    base = scratch.new_folder(spark, "increments")
    files.write_csv(us_states(spark), f"{base}/bronze/static")
    write_feeds(spark, f"{base}/bronze", 0, 8)
    return base


def contents(tables):
    return {name: sorted(map(tuple, df.collect()), key=str) for name, df in tables.items()}


@pytest.mark.parametrize("least_rows", [0, 10**6], ids=["folders", "no-folders"])
def test_appended_days_equal_a_rebuild(spark, base, least_rows):
    catalog.ensure_databases(spark, "increments", f"{base}/databases")
    pipeline.run(spark, base, prefix="increments", least_rows=least_rows)
    for number, (first, last) in enumerate([(8, 9), (9, 14)]):
        write_feeds(spark, f"{base}/feed{number}", first, last)
        appended = increments.append_days(spark, base, f"{base}/feed{number}", prefix="increments")
    appended = contents(appended)
    registered = {
        name: sorted(map(tuple, spark.table(f"increments_gold.{name}").select(*df.columns).collect()), key=str)
        for name, df in pipeline.gold_tables(spark, base).items()
    }
    silver = contents(pipeline.silver_tables(spark, base))
    whole = scratch.new_folder(spark, "rebuilt")
    files.write_csv(us_states(spark), f"{whole}/bronze/static")
    write_feeds(spark, f"{whole}/bronze", 0, 14)
    rebuilt = contents(pipeline.run(spark, whole, register=False, least_rows=least_rows))
    assert appended == rebuilt == registered
    assert silver == contents(pipeline.silver_tables(spark, whole))


def test_late_rows_are_refused(spark, base):
    pipeline.run(spark, base, register=False)
    before = contents(pipeline.gold_tables(spark, base))
    write_feeds(spark, f"{base}/again", 5, 9)
    with pytest.raises(ValueError, match="do not come after"):
        increments.append_days(spark, base, f"{base}/again")
    assert contents(pipeline.gold_tables(spark, base)) == before
    # The same days a second time, after they went in.
    write_feeds(spark, f"{base}/next", 8, 9)
    increments.append_days(spark, base, f"{base}/next")
    with pytest.raises(ValueError, match="do not come after"):
        increments.append_days(spark, base, f"{base}/next")


def test_new_facts_read_the_tail_and_no_old_partition(spark, base):
    pipeline.run(spark, base, register=False, least_rows=0)
    write_feeds(spark, f"{base}/next", 8, 9)
    increments.append_days(spark, base, f"{base}/next")
    new = pipeline.silver_tables(spark, base)["cases_standardized"].where("day = 9")
    path = scratch.new_folder(spark, "new")
    files.write_plain(new, path)
    new = files.read_parquet(spark, path, new.schema)
    read = increments.new_fact(new, increments.tail_of(spark, base, "cases"), "cases").inputFiles()
    assert any("/tails/" in name for name in read)
    assert not any(f"{base}/gold" in name or f"{base}/silver" in name for name in read)


def test_moving_average_over_a_tail(spark):
    rows = [("a", i, i * i % 11) for i in range(40)] + [("b", i, i) for i in range(3)]
    df = spark.createDataFrame(rows, "k string, d int, v int")
    whole = {tuple(r) for r in series.moving_avg(df, {"m": "v"}, ["k"], ["d"]).collect()}
    tail = None
    for first, last in ((0, 2), (2, 20), (20, 21), (21, 40)):
        part = df.where(f"d >= {first} and d < {last}")
        found = series.moving_avg(part, {"m": "v"}, ["k"], ["d"], before=tail if tail else part.limit(0))
        assert {tuple(r) for r in found.collect()} == {row for row in whole if first <= row[1] < last}
        cut = series.moving_avg(part, {"m": "v"}, ["k"], ["d"], hot_rows=4, before=tail if tail else part.limit(0))
        assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, found.collect()))
        # Six rows of every series are enough for a mean of seven.
        ends = series.tail(part, ["k"], ["d"], 6, before=tail)
        tail = spark.createDataFrame(ends.collect(), df.schema)
        assert tail.groupBy("k").count().agg({"count": "max"}).first()[0] <= 6
    early = spark.createDataFrame([("a", 5, 1), ("c", 1, 1), ("b", 9, 1)], df.schema)
    assert [row.k for row in series.late(early, tail, ["k"], ["d"]).collect()] == ["a"]
