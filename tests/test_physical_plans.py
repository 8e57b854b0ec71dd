"""What the executed plans must and must not contain."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from daystar import contracts
from daystar.operators import lookups, series
from daystar.plans import facts, marts
from daystar.sources import catalog, files, scratch
from tests.compare import plan_of


@pytest.fixture(scope="module")
def gold(spark):
    days = spark.range(600).select(
        (20200000 + F.col("id") % 100).cast("int").alias("date_id"),
        F.concat(F.lit("N"), (F.col("id") % 6).cast("string")).alias("state_code"),
        *[F.col("id").alias(name) for name in ("cases_cum", "deaths_cum", "new_cases", "new_deaths")],
    )
    path = scratch.new_folder(spark, "plans")
    files.write_parquet(days, path, ["state_code"])
    return files.read_parquet(spark, path, contracts.FACT_CASES)


@pytest.fixture
def lookup(frame):
    return frame("state_code string, state_name string", ("N1", "One"), ("N2", "Two"))


def test_region_filter_prunes_partitions(gold):
    plan = plan_of(marts.filter_region(gold, "N1").select("new_cases"))
    assert "PartitionFilters: [isnotnull(state_code" in plan
    assert "ReadSchema: struct<new_cases:bigint>" in plan


def test_date_filter_reaches_the_scan(gold):
    assert "EqualTo(date_id,20200042)" in plan_of(marts.filter_date(gold, "20200042"))


def test_top_n_needs_no_shuffle(gold, lookup):
    small = lookups.pick_regions(lookup)
    top = marts.top_n_on_date(gold, lookup, 20200042)
    plan = plan_of(top)
    assert "TakeOrderedAndProject" in plan and "EqualTo(date_id,20200042)" in plan
    assert small.count() == 2


def test_named_regions_prune_partitions_at_run_time(gold, lookup):
    plan = plan_of(marts.cases_trend(gold, lookup, names=["One"]))
    assert "dynamicpruning" in plan and "BroadcastHashJoin" in plan


def test_first_n_limits_before_every_shuffle(gold):
    plan = plan_of(series.first_n(gold, ["state_code"], ["date_id"], 10))
    assert plan.count("WindowGroupLimit") == 4


def test_short_series_end_up_with_one_shuffle_and_one_scan(gold):
    spec = {"keys": ["state_code"], "order_by": ["date_id"]}
    plan = plan_of(series.daily_delta(gold, {"x": "cases_cum", "y": "deaths_cum"}, **spec))
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1
    assert plan.count("+- Window") == 1 and "Union" not in plan and "Join" not in plan


def test_facts_are_written_without_a_second_shuffle(spark, gold):
    silver = gold.select(
        F.to_date(F.lit("2020-01-01")).alias("full_date"), "state_code", "cases_cum", "deaths_cum"
    )
    fact = facts.cases(silver, hot_rows=None)
    path = scratch.new_folder(spark, "fact")
    files.write_parquet(fact, path, ["state_code"], gather=False)
    stored = spark.read.parquet(path).select("state_code", F.input_file_name().alias("file"))
    per_region = stored.distinct().groupBy("state_code").count().collect()
    assert {row["count"] for row in per_region} == {1} and len(per_region) == 6


@pytest.fixture
def settings(spark):
    """Sets settings of the session for one test."""
    before = {}

    def put(**values):
        for name, value in values.items():
            key = "spark.sql." + name.replace("_", ".")
            before.setdefault(key, spark.conf.get(key))
            spark.conf.set(key, value)

    yield put
    for key, value in before.items():
        spark.conf.set(key, value)


def test_facts_by_key_are_joined_where_they_are(spark, gold, settings):
    settings(autoBroadcastJoinThreshold="-1")
    prefix = "plans_by_key"
    catalog.ensure_databases(spark, prefix, scratch.new_folder(spark, "databases"))
    names = [f"{prefix}_gold.{name}" for name in ("cases", "tests")]
    tests = gold.withColumnsRenamed({"new_cases": "new_tests", "cases_cum": "tests_total_cum", "deaths_cum": "tests_pos_cum"})
    for name, fact in zip(names, (gold, tests), strict=True):
        catalog.replace_bucketed(fact, name, ["state_code", "date_id"], 4)
        assert len(spark.table(name).inputFiles()) == 4
    cases, tests = map(spark.table, names)
    dates = gold.select("date_id").distinct().withColumn("full_date", F.lit(None).cast("date"))
    joined = cases.join(tests.select("date_id", "state_code", "new_tests"), ["date_id", "state_code"])
    plan = plan_of(joined)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    report = plan_of(marts.cases_vs_tests(cases, tests, dates))
    assert "hashpartitioning(state_code" not in report and "hashpartitioning(date_id#" in report


def test_known_rows_of_a_lookup_decide_the_broadcast(spark, settings):
    """Its file is beyond the threshold for a broadcast; the columns that the join needs are not."""
    folder, prefix = scratch.new_folder(spark, "statistics"), "plans_statistics"
    wide = spark.range(2000).select(
        F.concat(F.lit("N"), "id").alias("state_code"), F.sha2(F.col("id").cast("string"), 512).alias("notes")
    )
    files.write_csv(wide, f"{folder}/lookup")
    catalog.ensure_databases(spark, prefix, f"{folder}/databases")
    name = f"{prefix}_bronze.lookup"
    catalog.register_csv(spark, name, wide.schema, f"{folder}/lookup")
    settings(autoBroadcastJoinThreshold="102400", adaptive_enabled="false", cbo_enabled="true")
    codes = spark.range(10**6).select(F.concat(F.lit("N"), "id").alias("state_code"))
    unknown = plan_of(codes.join(spark.table(name).select("state_code"), "state_code"))
    catalog.analyze(spark, name)
    known = plan_of(codes.join(spark.table(name).select("state_code"), "state_code"))
    assert "SortMergeJoin" in unknown and "BroadcastHashJoin" in known
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Statistics'").first()
    assert "2000 rows" in described["data_type"]
