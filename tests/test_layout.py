"""Planned layouts: folders that are worth it, files as planned, and compaction."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from daystar import contracts
from daystar.plans import pipeline
from daystar.sources import catalog, files, layout, scratch, versions
from tests.test_pipeline import bronze

KEYS = ["state", "year", "day"]


@pytest.fixture
def rows(spark):
    """1,000 rows a day of one state, 10 of the other, 3 of no state; 20 days in two years."""
    sizes = F.when(F.col("id") % 3 == 0, 1000).when(F.col("id") % 3 == 1, 10).otherwise(3)
    return spark.range(60).select(
        F.when(F.col("id") % 3 == 0, "large").when(F.col("id") % 3 == 1, "small").alias("state"),
        (2020 + F.floor(F.col("id") / 30)).cast("int").alias("year"),
        F.floor(F.col("id") / 3).cast("int").alias("day"),
        F.explode(F.sequence(F.lit(1), sizes)).alias("value"),
    )


def report(spark, path):
    row = layout.folder_report(spark, path).first()
    return row["folders"], row["files"]


@pytest.mark.parametrize(
    ("least", "wanted"), [(0, KEYS), (300, KEYS), (400, ["state", "year"]), (6000, ["state"]), (10**6, [])]
)
def test_folders_are_worth_their_rows(spark, rows, least, wanted):
    assert layout.worthwhile(layout.partition_sizes(rows, KEYS), KEYS, least) == wanted


def test_no_rows_have_no_folders(spark, rows):
    path = scratch.new_folder(spark, "layout")
    assert layout.replace_planned(rows.limit(0), path, KEYS, least_rows=0) == []
    assert files.read_parquet(spark, path, rows.schema).count() == 0


def test_files_are_as_planned(spark, rows):
    """Every small folder has one file, every large one the files that its rows need."""
    path = scratch.new_folder(spark, "layout")
    plan = layout.file_plan(layout.partition_sizes(rows, KEYS), KEYS, file_rows=300)
    assert layout.files_planned(plan) == 20 * 4 + 20 + 20
    # Bins of small partitions: 200 rows of one state, 60 without, beside 20 large ones.
    small = plan.where("rows < 300").groupBy("state").agg(F.count_distinct("__bin").alias("bins")).collect()
    assert {row["state"]: row["bins"] for row in small} == {"small": 1, None: 1}
    assert layout.replace_planned(rows, path, KEYS, least_rows=0, file_rows=300) == KEYS
    folders, found = report(spark, path)
    # 1,000 rows of a partition are dealt by hash to four files of 250, give or take.
    assert folders == 60 and 40 + 20 * 4 <= found <= 40 + 20 * 6
    per_file = spark.read.parquet(versions.current(spark, path)).groupBy(F.input_file_name()).count()
    assert per_file.agg(F.max("count")).first()[0] <= 300
    assert layout.partition_columns(spark, path) == KEYS
    found = files.read_parquet(spark, path, rows.schema)
    assert found.exceptAll(rows).isEmpty() and found.count() == rows.count()


def test_folded_levels_stay_in_the_files(spark, rows):
    path = scratch.new_folder(spark, "layout")
    assert layout.replace_planned(rows, path, KEYS, least_rows=6000) == ["state"]
    assert report(spark, path) == (3, 3)
    assert files.read_parquet(spark, path, rows.schema).exceptAll(rows).isEmpty()


def test_compaction_touches_crowded_partitions_only(spark, rows):
    folder = scratch.new_folder(spark, "compaction")
    catalog.ensure_databases(spark, "layout_test", folder)
    name = "layout_test_silver.days"
    rows = rows.withColumn("state", F.coalesce("state", F.lit("none"))).where("day < 3")
    files.write_parquet(rows.repartition(6), f"{folder}/days", ["state", "year"], gather=False)
    catalog.register_parquet(spark, name, rows.schema, f"{folder}/days", ["state", "year"])
    catalog.append_partitions(rows.where("state = 'small'").withColumn("year", F.lit(2030)), name)

    def placed():
        described = spark.table(name).select("state", "year", "_metadata.file_path").distinct().collect()
        return {(r["state"], r["year"]): {x["file_path"] for x in described if x[:2] == r[:2]} for r in described}

    before, total = placed(), spark.table(name).count()
    assert catalog.compact_partitions(spark, name) == sum(len(found) > 1 for found in before.values()) > 0
    after = placed()
    assert {len(found) for found in after.values()} == {1}
    assert after["small", 2030] == before["small", 2030]
    assert spark.table(name).count() == total
    assert catalog.compact_partitions(spark, name) == 0


def test_default_job_folds_and_registers(spark):
    """The default four levels: folders of all of them on demand, none for a feed of a few rows."""
    base, prefix = scratch.new_folder(spark, "job"), "fold_test"
    bronze(spark, base)
    catalog.ensure_databases(spark, prefix, f"{base}/databases")
    path, name = f"{base}/silver/cases_standardized", f"{prefix}_silver.cases_standardized"
    rows = []
    for least, wanted in ((layout.LEAST_ROWS, []), (0, list(pipeline.SILVER_PARTITIONS))):
        pipeline.run(spark, base, prefix=prefix, least_rows=least)
        assert layout.partition_columns(spark, path) == wanted
        assert report(spark, path) == ((24, 24) if wanted else (1, 1))
        silver = files.read_parquet(spark, path, contracts.SILVER_CASES)
        rows.append(sorted(map(tuple, silver.collect())))
        table = spark.table(name).select(*silver.columns)
        assert sorted(map(tuple, table.collect())) == rows[-1]
    assert rows[0] == rows[1]


def test_first_rows_read_the_first_ranges_only(spark):
    """Ten times as many rows: the same ten are read from as many files, of about the same size."""
    read = []
    for rows in (20_000, 200_000):
        path = scratch.new_folder(spark, "ranges")
        df = spark.range(rows).select(F.when(F.col("id") % 10 > 0, F.col("id")).alias("k"), F.col("id").alias("v"))
        assert layout.replace_ranges(df, path, "k", range_rows=1000) == rows // 1000
        found = layout.first_rows(spark, path, df.schema, "k", n=10)
        assert [row.k for row in found.collect()] == [1, 2, 3, 4, 5, 6, 7, 8, 9, 11]
        read.append(found.inputFiles())
        assert layout.first_rows(spark, path, df.schema, "k", n=5000).count() == 5000
    assert len(read[0]) == len(read[1]) == 1


def test_first_rows_of_few(spark):
    df = spark.createDataFrame([(None, 1), (2, 2), (1, 3)], "k int, v int")
    for rows, wanted in ((df, [1, 2, None]), (df.limit(0), [])):
        path = scratch.new_folder(spark, "ranges")
        layout.replace_ranges(rows, path, "k")
        assert [row.k for row in layout.first_rows(spark, path, df.schema, "k").collect()] == wanted
