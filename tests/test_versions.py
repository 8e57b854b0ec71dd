"""Full replacement without a gap, and partitions registered one write at a time."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from daystar.operators import quality
from daystar.plans import pipeline
from daystar.sources import catalog, files, scratch, versions
from tests.compare import plan_of


@pytest.fixture
def folder(spark):
    return scratch.new_folder(spark, "versions")


@pytest.fixture
def database(spark, folder):
    catalog.ensure_databases(spark, "versions_test", folder)
    return "versions_test_silver"


def dying(df):
    """The same rows, but the job fails after it has begun to write."""
    return df.repartition(4).withColumn(
        "id", F.when(F.col("id") == 77, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id"))
    )


def ids(df):
    return sorted(row.id for row in df.collect())


def test_a_failed_write_leaves_the_rows_of_before(spark, folder):
    path = f"{folder}/table"
    files.replace_parquet(spark.range(5), path)
    open_before = files.read_parquet(spark, path)
    with pytest.raises(PySparkException):
        files.replace_parquet(dying(spark.range(100)), path)
    assert ids(files.read_parquet(spark, path)) == [0, 1, 2, 3, 4]
    # A writer whose machine is lost leaves a folder without the mark of a complete write.
    spark.range(9).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", False).parquet(
        versions.new_version(spark, path)
    )
    assert ids(files.read_parquet(spark, path)) == [0, 1, 2, 3, 4]
    files.replace_parquet(spark.range(7), path)
    assert ids(files.read_parquet(spark, path)) == list(range(7))
    assert ids(open_before) == [0, 1, 2, 3, 4]


def test_old_versions_go(spark, folder):
    path = f"{folder}/table"
    for n in range(5):
        files.replace_parquet(spark.range(n), path)
    assert [number for number, _ in versions.versions(spark, path)] == [4, 5]
    assert versions.current(spark, f"{folder}/nothing") == f"{folder}/nothing"


def test_a_failed_replacement_leaves_the_table(spark, database):
    name = f"{database}.cases"
    catalog.replace_table(spark.range(3), name)
    with pytest.raises(PySparkException):
        catalog.replace_table(dying(spark.range(100)), name)
    assert ids(spark.table(name)) == [0, 1, 2]
    # The query may read the table that it replaces.
    catalog.replace_table(spark.table(name).union(spark.range(10, 12)), name)
    assert ids(spark.table(name)) == [0, 1, 2, 10, 11]
    catalog.replace_table(spark.range(1).withColumn("more", F.lit("x")), name)
    assert [tuple(row) for row in spark.table(name).collect()] == [(0, "x")]


SCHEMA = "v int, s string, d int"


def test_append_adds_and_merges_partitions(spark, folder, database):
    data = spark.createDataFrame([(1, "a b/c", 1), (2, None, 2), (3, "é=1", 3)], SCHEMA)
    name = f"{database}.parts"
    files.replace_parquet(data, f"{folder}/parts", ["s", "d"])
    catalog.register_parquet(spark, name, data.schema, f"{folder}/parts", ["s", "d"])
    more = spark.createDataFrame([(9, "a b/c", 1), (8, None, 2), (7, "new", 3), (6, None, 9)], SCHEMA)
    assert catalog.append_partitions(more, name) == 4
    rows = sorted((tuple(row) for row in spark.table(name).collect()), key=str)
    assert rows == sorted((tuple(row) for row in data.union(more).collect()), key=str)
    assert catalog.append_partitions(more.limit(0), name) == 0
    # Once more into partitions that have been switched already.
    catalog.append_partitions(spark.createDataFrame([(5, "new", 3)], SCHEMA), name)
    assert sorted(row.v for row in spark.table(name).where("s = 'new'").collect()) == [5, 7]


def test_append_lists_only_what_it_wrote(spark, folder, database, monkeypatch):
    """Ten thousand partitions are there; their folders are never looked at."""
    name, path = f"{database}.many", f"{folder}/many"
    first = spark.createDataFrame([(1, "x", 0)], SCHEMA)
    files.write_parquet(first, path, ["s", "d"])
    catalog.register_parquet(spark, name, first.schema, path, ["s", "d"])
    for start in range(1, 10_001, 1000):
        specs = " ".join(
            f"PARTITION (s = 'x', d = {d}) LOCATION '{path}/s=x/d=0'" for d in range(start, start + 1000)
        )
        spark.sql(f"ALTER TABLE {name} ADD {specs}")
    listed = []
    monkeypatch.setattr(
        versions, "children", lambda spark, path, own=versions.children: listed.append(path) or own(spark, path)
    )
    monkeypatch.setattr(catalog, "repair", None)
    catalog.append_partitions(spark.createDataFrame([(2, "y", 5)], SCHEMA), name)
    assert len(listed) == 2 and all("/batch-" in place for place in listed)
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == 10_002
    assert [row.v for row in spark.table(name).where("s = 'y'").collect()] == [2]


def star(frame):
    dates, states = "date_id int, x int", "state_code string"
    facts = "date_id int, state_code string"
    return {
        "dim_date": frame(dates, (1, 0), (2, 0), (2, 0), (None, 0)),
        "dim_state": frame(states, "A", "A", "B", None, None),
        "fact_cases_state_daily": frame(facts, (1, "A"), (1, "A"), (3, "A"), (None, "A"), (None, "A"), (2, None)),
        "fact_testing_state_daily": frame(facts, (1, "A"), (7, "A")),
    }


def test_checks_in_one_job_equal_single_checks(frame):
    gold, wanted = star(frame), {}
    for name, table in gold.items():
        key = [column for column in table.columns if column != "x"]
        wanted[f"{name}: missing key"] = quality.null_violations(table, key).count()
        wanted[f"{name}: repeated key"] = quality.duplicate_keys(table, key).count()
        if name.startswith("fact_"):
            orphans = quality.orphans(table, gold["dim_date"], "date_id")
            wanted[f"{name}: date not in dim_date"] = orphans.count()
    assert pipeline.faults(gold) == wanted


def test_checks_scan_every_table_once(spark, frame, folder):
    tables = {}
    for name, table in star(frame).items():
        files.write_parquet(table, f"{folder}/{name}")
        key = [column for column in table.columns if column != "x"]
        tables[name] = (files.read_parquet(spark, f"{folder}/{name}"), key)
    plan = plan_of(quality.key_faults(tables, parent="dim_date", by="date_id"))
    assert plan.count("FileScan") == 4 and "Join" not in plan
    assert "x#" not in plan
    empty = {"t": (spark.range(0), ["id"])}
    assert {row["rows"] for row in quality.key_faults(empty).collect()} == {0}
