from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from daystar import contracts
from daystar.sources import catalog, files, scratch


@pytest.fixture
def folder(spark):
    return scratch.new_folder(spark, "test")


def text_file(path, text):
    path.mkdir()
    (path / "part.csv").write_text(text)
    return str(path)


def test_csv_skips_a_blank_line_before_the_header(spark, tmp_path):
    path = text_file(tmp_path / "lookup", "\nabbr,name\nAL,Alabama\n")
    for schema in (None, contracts.BRONZE_LOOKUP):
        df = files.read_csv(spark, path, schema)
        assert df.columns == ["abbr", "name"]
        assert [tuple(row) for row in df.collect()] == [("AL", "Alabama")]


def test_csv_finds_columns_by_name(spark, tmp_path):
    path = text_file(tmp_path / "cases", "date,fips,state,cases\n2020-05-01,36,New York,7\n")
    row = files.read_csv(spark, path).select("state", "cases").first()
    assert tuple(row) == ("New York", "7")


def test_csv_with_another_header_fails(spark, tmp_path):
    path = text_file(tmp_path / "lookup", "name,abbr\nAlabama,AL\n")
    with pytest.raises(Exception, match="header"):
        files.read_csv(spark, path, contracts.BRONZE_LOOKUP).collect()


def test_csv_keeps_blanks(spark, frame, folder):
    files.write_csv(frame("a string, b int", (" x ", 1)), folder)
    assert [tuple(row) for row in files.read_csv(spark, folder).collect()] == [(" x ", "1")]


def test_partition_values_keep_their_type(spark, frame, folder):
    df = frame("v int, year string, month string", (1, "2020", "05"), (2, "2020", None))
    files.write_parquet(df, folder, ["year", "month"])
    assert dict(files.read_parquet(spark, folder).dtypes)["month"] == "int"
    back = files.read_parquet(spark, folder, df.schema)
    assert back.columns == ["v", "year", "month"]
    assert sorted(map(tuple, back.collect())) == [(1, "2020", "05"), (2, "2020", None)]


def test_overwrite_replaces_everything(spark, frame, folder):
    files.write_parquet(frame("v int, k string", (1, "a"), (2, "b")), folder, ["k"])
    files.write_parquet(frame("v int, k string", (3, "c")), folder, ["k"])
    assert [tuple(row) for row in spark.read.parquet(folder).collect()] == [(3, "c")]


def test_sorted_output_is_in_key_order(spark, folder):
    df = spark.range(1000).select(F.expr("hash(id)").alias("k"))
    files.write_parquet(df, folder, order_by=["k"])
    ranges = (
        spark.read.parquet(folder)
        .groupBy(F.input_file_name().alias("f"))
        .agg(F.min("k").alias("low"), F.max("k").alias("high"))
        .orderBy("f")
        .collect()
    )
    assert all(a.high <= b.low for a, b in zip(ranges, ranges[1:]))


def test_hot_partition_is_split_and_small_ones_share_tasks(spark):
    """One value with most rows is written by several tasks."""
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "512KB")
    try:
        path = scratch.new_folder(spark, "skew")
        df = spark.range(400_000, numPartitions=16).select(
            F.when(F.col("id") % 3 == 0, F.col("id") % 20).otherwise(99).cast("string").alias("k"),
            F.rand(1).alias("v"),
        )
        files.write_parquet(df, path, ["k"])
        per_value = (
            spark.read.parquet(path)
            .select("k", F.input_file_name().alias("f"))
            .distinct()
            .groupBy("k")
            .count()
        )
        counts = {row["k"]: row["count"] for row in per_value.collect()}
    finally:
        spark.conf.set(name, before)
    # Values that share a shuffle partition with the hot one are split along with it.
    assert counts.pop(99) > 4
    assert sum(1 for files_ in counts.values() if files_ == 1) > 10


@pytest.fixture
def databases(spark):
    prefix = f"test_{scratch.new_folder(spark, 'p').rsplit('-', 1)[1][:8]}"
    catalog.ensure_databases(spark, prefix, scratch.new_folder(spark, "db"))
    catalog.ensure_databases(spark, prefix)
    return {layer: catalog.database(layer, prefix) for layer in catalog.LAYERS}


def test_positional_csv_table(spark, tmp_path, databases):
    path = text_file(tmp_path / "states", "anything,at all\nNY,New York\n")
    name = f"{databases['bronze']}.raw_states"
    catalog.register_csv(spark, name, contracts.BRONZE_REGIONS, path)
    catalog.register_csv(spark, name, contracts.BRONZE_REGIONS, path)
    assert [tuple(row) for row in spark.table(name).collect()] == [("NY", "New York")]
    assert spark.table(name).columns == ["state_code", "state_name"]


def test_parquet_table_sees_partitions_after_repair(spark, frame, folder, databases):
    first = frame("v int, k string", (1, "a"))
    files.write_parquet(first, folder, ["k"])
    name = f"{databases['gold']}.facts"
    catalog.register_parquet(spark, name, first.schema, folder, ["k"])
    assert spark.table(name).count() == 1
    frame("v int, k string", (2, "b")).write.mode("append").partitionBy("k").parquet(folder)
    assert spark.table(name).count() == 1
    catalog.repair(spark, name)
    assert sorted(map(tuple, spark.table(name).collect())) == [(1, "a"), (2, "b")]


def test_registering_again_drops_the_old_table(spark, frame, folder, databases):
    name = f"{databases['gold']}.dim"
    df = frame("d date, n int", (date(2020, 5, 1), 1))
    files.write_parquet(df, folder)
    catalog.register_parquet(spark, name, df.select("d").schema, folder)
    catalog.register_parquet(spark, name, df.schema, folder)
    assert [tuple(row) for row in spark.table(name).collect()] == [(date(2020, 5, 1), 1)]


def test_replace_table(spark, frame, databases):
    name = f"{databases['silver']}.cases"
    catalog.replace_table(frame("a int, b int", (1, 2)), name)
    catalog.replace_table(frame("a string", "x"), name)
    assert [tuple(row) for row in spark.table(name).collect()] == [("x",)]


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Conf:
        def get(self, key, default):
            return default

    class Session:
        conf = Conf()
        sparkContext = type("Context", (), {"master": "yarn", "applicationId": "none", "getCheckpointDir": lambda self: None})()

    with pytest.raises(RuntimeError):
        scratch.shared_folder(Session())
    Session.sparkContext.master = "local[2]"
    assert scratch.shared_folder(Session())
