from __future__ import annotations

from daystar import contracts
from daystar.operators import quality
from daystar.plans import pipeline
from daystar.sources import catalog, files, scratch
from daystar.sources.us_states import us_states


def bronze(spark, base):
    days = [f"2020-05-{d:02d}" for d in range(1, 13)]
    names = [("New York", "NY"), ("Texas", "TX"), ("Guam", "GU")]
    cases = [(d, n, str(i * 10), str(i)) for n, _ in names for i, d in enumerate(days)]
    tests = [
        (d.replace("-", ""), c, str(i * 100), str(i * 10), str(i * 90))
        for _, c in names
        for i, d in enumerate(days[:-1])
    ]
    files.write_csv(spark.createDataFrame(cases, contracts.BRONZE_CASES), f"{base}/bronze/cases")
    files.write_csv(spark.createDataFrame(tests, contracts.BRONZE_TESTS), f"{base}/bronze/tests")
    files.write_csv(us_states(spark), f"{base}/bronze/static")


def contents(tables):
    return {name: sorted(map(tuple, df.collect()), key=str) for name, df in tables.items()}


def test_run_twice_gives_the_same_star(spark):
    base, prefix = scratch.new_folder(spark, "job"), "job_test"
    bronze(spark, base)
    catalog.ensure_databases(spark, prefix, f"{base}/databases")
    first = contents(pipeline.run(spark, base, prefix=prefix))
    second = contents(pipeline.run(spark, base, prefix=prefix))
    assert first == second
    assert {name: len(rows) for name, rows in first.items()} == {
        "dim_date": 12,
        "dim_state": 2,
        "fact_cases_state_daily": 24,
        "fact_testing_state_daily": 33,
    }
    gold = pipeline.gold_tables(spark, base)
    for name in ("fact_cases_state_daily", "fact_testing_state_daily"):
        assert quality.is_empty(quality.duplicate_keys(gold[name], ["date_id", "state_code"]))
        assert quality.is_empty(quality.orphans(gold[name], gold["dim_date"], "date_id"))
    registered = spark.table(f"{prefix}_gold.fact_cases_state_daily")
    assert registered.where("state_code = 'NY'").agg({"new_cases": "sum"}).first()[0] == 110
    assert spark.table(f"{prefix}_silver.cases_standardized").count() == 24
    assert spark.table(f"{prefix}_bronze.states_lookup").count() == 51


def test_text_key_variant(spark):
    base = scratch.new_folder(spark, "job")
    bronze(spark, base)
    pipeline.build_silver_text_key(spark, base)
    pipeline.build_gold_text_key(spark, base)
    silver = files.read_parquet(spark, f"{base}/silver/cases_standardized")
    assert silver.count() == 36 and dict(silver.dtypes)["month"] == "int"
    fact = files.read_parquet(spark, f"{base}/gold/fact_testing_state_daily")
    assert fact.columns[-2:] == ["new_tests", "positivity_rate"]
    assert {row.positivity_rate for row in fact.collect()} == {None, 10.0}
    assert files.read_parquet(spark, f"{base}/gold/dim_state").count() == 3


def test_refresh_feed(spark):
    base = scratch.new_folder(spark, "feed")
    feed = [(" NY ", "1"), ("ZZ", "x")]
    rows = [("2020-05-01", state, cases, "0", "1", "0") for state, cases in feed]
    files.write_csv(spark.createDataFrame(rows, contracts.BRONZE_FEED), f"{base}/feed")
    regions = spark.createDataFrame([("NY", "New York")], contracts.BRONZE_REGIONS)
    files.write_csv(regions, f"{base}/regions")
    args = (spark, f"{base}/feed", f"{base}/regions", "feed_test", f"{base}/databases")
    pipeline.refresh_feed(*args)
    fact = pipeline.refresh_feed(*args)
    assert sorted(map(tuple, fact.collect()), key=str) == [
        ("2020-05-01", "New York", 1, 0, 1, 0), ("2020-05-01", None, None, 0, 1, 0)
    ]


def test_publish(spark):
    base = scratch.new_folder(spark, "job")
    bronze(spark, base)
    pipeline.run(spark, base, silver_partitions=("state_code",), register=False)
    pipeline.publish_star(spark, base)
    published = spark.read.parquet(f"{base}/published/dim_date")
    assert dict(published.dtypes)["dow"] == "smallint"
    assert spark.read.parquet(f"{base}/published/fact_cases_state_daily").count() == 24
