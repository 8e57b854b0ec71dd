"""Planned layouts: which partition folders a table gets, and which rows share a file.

Sizes are measured before rows are written. Levels of folders that would hold too few rows
are left out, their columns stay in the files; every remaining folder gets as many files as its
rows need, and small folders that follow each other are written by one task.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Window
from pyspark.sql import functions as F

from daystar.sources import files, scratch, versions

#: Rows that a folder has at least on average; a folder costs a file and its share of every listing.
LEAST_ROWS = 100_000
#: Rows of a file, about; also what one task writes.
FILE_ROWS = 4_000_000

_BIN, _FILES, _PART, _RANGE = "__bin", "__files", "__part", "range"


def partition_sizes(df, keys):
    """`rows` by value of `keys`; reads the key columns only."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))


def worthwhile(sizes, keys, least_rows=LEAST_ROWS):
    """The leading `keys` whose folders hold `least_rows` rows on average."""
    keys = list(keys)
    folders = [F.count_distinct(F.struct(*keys[: n + 1])).alias(str(n)) for n in range(len(keys))]
    measured = sizes.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), *folders).first()
    fits = [n + 1 for n in range(len(keys)) if 0 < measured[str(n)] and measured["rows"] >= least_rows * measured[str(n)]]
    return keys[: max(fits, default=0)]


def file_plan(sizes, keys, file_rows=FILE_ROWS):
    """Files and bin of every partition: large ones have files of their own, small ones share a bin.

    Bins are filled in key order within a value of the first key, by a running sum over
    partitions, not rows.
    """
    keys = list(keys)
    in_order = Window.partitionBy(keys[0]).orderBy(*keys)
    before = F.sum("rows").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    files_of = F.greatest(F.ceil(F.col("rows") / file_rows), F.lit(1)).cast("int")
    return sizes.select(
        *keys,
        "rows",
        files_of.alias(_FILES),
        F.floor(F.coalesce(before, F.lit(0)) / file_rows).alias(_BIN),
    )


def files_planned(plan):
    """Number of files that a plan asks for."""
    return plan.agg(F.coalesce(F.sum(_FILES), F.lit(0))).first()[0]


def _tasks_planned(plan, keys):
    """One task per bin of small partitions and per file of a large one."""
    small = F.when(F.col(_FILES) == 1, F.struct(keys[0], _BIN))
    large = F.coalesce(F.sum(F.when(F.col(_FILES) > 1, F.col(_FILES))), F.lit(0))
    return max(plan.agg((F.count_distinct(small) + large).alias("tasks")).first()["tasks"], 1)


def arranged(df, keys, plan):
    """Rows dealt to tasks as planned: a bin of small partitions to one, a large partition to several."""
    keys = list(keys)
    columns = [name for name in df.columns if name not in keys]
    listed = plan.select(*[F.col(key).alias(f"__{key}") for key in keys], _FILES, _BIN)
    same = reduce(and_, [F.col(key).eqNullSafe(F.col(f"__{key}")) for key in keys])
    # Which of a large partition's files a row goes to follows from the row, so a task that runs again deals alike.
    part = F.when(F.col(_FILES) > 1, F.pmod(F.xxhash64(*columns), F.col(_FILES))).otherwise(0)
    large = [F.when(F.col(_FILES) > 1, F.col(key)) for key in keys[1:]]
    return (
        df.join(listed, same, "left")
        .withColumn(_PART, part)
        .repartition(_tasks_planned(plan, keys), F.col(keys[0]), F.col(_BIN), *large, F.col(_PART))
        .select(*df.columns)
        .sortWithinPartitions(*keys)
    )


def replace_planned(df, path, keys, least_rows=LEAST_ROWS, file_rows=FILE_ROWS, always=()):
    """Like `files.replace_parquet` with a measured layout; returns the partition columns it has.

    The columns of `always` are folders above all others whatever they hold.

    Rows are counted by `keys` first, from those columns alone; the counts, a row per value, are
    written, so the planner sees how small they are when rows look up their bin.
    """
    spark = df.sparkSession
    always, keys = list(always), list(keys)
    if always or keys:
        counted = scratch.new_folder(spark, "partition-sizes")
        files.write_plain(partition_sizes(df, [*always, *keys]), counted)
        sizes = spark.read.parquet(counted)
        keys = [*always, *(worthwhile(sizes, keys, least_rows) if keys else [])]
    if keys:
        sizes = sizes.groupBy(*keys).agg(F.sum("rows").alias("rows"))
        df = arranged(df, keys, file_plan(sizes, keys, file_rows))
    else:
        # No folders at all: a table of few rows, which are brought together.
        df = df.hint("rebalance")
    folder = versions.new_version(spark, path)
    # Should two files of a partition meet in a task, it starts the second one here.
    files.write_plain(df, folder, keys, maxRecordsPerFile=file_rows)
    versions.drop_old(spark, path)
    return keys


def replace_ranges(df, path, key, range_rows=FILE_ROWS):
    """Write a table as folders of neighbouring `key` values, in order, nulls last; returns how many.

    What is asked of its first rows is then answered from its first folder (see `first_rows`). Ranges are
    cut at sampled values, so they hold about `range_rows` rows; equal values stay together.
    """
    spark = df.sparkSession
    ranges = max(-(-df.count() // range_rows), 1)
    in_order = F.asc_nulls_last(key)
    placed = df.repartitionByRange(ranges, in_order).withColumn(_RANGE, F.spark_partition_id())
    folder = versions.new_version(spark, path)
    files.write_plain(placed.sortWithinPartitions(_RANGE, in_order), folder, [_RANGE])
    versions.drop_old(spark, path)
    return ranges


def first_rows(spark, path, schema, key, n=10):
    """The first `n` rows of a table in ranges, in key order, with the columns of `schema`; reads as many ranges as hold them.

    Ranges are named by a listing of one folder; rows of the first ones are counted from the descriptions
    of their files, so what is read does not grow with the table.
    """
    folder = versions.current(spark, path)
    names = [name for name in versions.children(spark, folder) if name.startswith(f"{_RANGE}=")]
    places = [f"{folder}/{name}" for name in sorted(names, key=lambda name: int(name.partition("=")[2]))]
    some = 1
    while some < len(places) and spark.read.schema(schema).parquet(*places[:some]).count() < n:
        some *= 2
    # A table without rows has no ranges.
    rows = spark.read.schema(schema).parquet(*places[:some]) if places else spark.createDataFrame([], schema)
    return rows.orderBy(F.asc_nulls_last(key)).limit(n)


def partition_columns(spark, path):
    """Partition columns of a Parquet folder, from the names of its first folders."""
    found, place = [], versions.current(spark, path)
    while True:
        inner = [name for name in versions.children(spark, place) if "=" in name]
        if not inner:
            return found
        found.append(inner[0].partition("=")[0])
        place = f"{place}/{inner[0]}"


def folder_report(spark, path):
    """`folders`, `files` and `bytes` of what a Parquet folder holds, from a listing alone."""
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", True)
        .load(versions.current(spark, path))
    )
    return listed.select(F.regexp_extract("path", "^(.*)/", 1).alias("folder"), "length").agg(
        F.count_distinct("folder").alias("folders"),
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
    )
