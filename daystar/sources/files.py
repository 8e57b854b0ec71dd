"""CSV and Parquet, in and out."""

from __future__ import annotations

from pyspark.sql import functions as F

from daystar.sources import versions


def read_csv(spark, path, schema=None):
    """CSV with a header, all text unless `schema` says otherwise.

    Columns are found by header name. With a `schema` of the columns, in order,
    every file's header is checked against it, so that a file with other columns
    fails instead of being read wrongly.
    """
    reader = spark.read.option("header", True)
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", False)
    return reader.csv(path)


def read_parquet(spark, path, schema=None):
    """Parquet folder with its partition columns, in contract order if a `schema` is given.

    The schema also keeps partition values in their declared type. Of a folder that
    `replace_parquet` writes, the newest complete version is read.
    """
    path = versions.current(spark, path)
    if schema is None:
        return spark.read.parquet(path)
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def write_parquet(df, path, partition_by=(), order_by=(), gather=True):
    """Write a Parquet folder in place of an earlier one.

    With `partition_by`, rows are first brought together by partition value, so a
    folder gets few files; adaptive execution splits the values that hold too many
    rows for one task and merges the small ones. `gather=False` saves that shuffle
    for rows that are together already. With `order_by`, files are in key order, or
    sorted inside each partition folder. The earlier rows go before the new ones
    are there; `replace_parquet` keeps them until then.
    """
    write_plain(_arranged(df, partition_by, order_by, gather), path, partition_by)


def replace_parquet(df, path, partition_by=(), order_by=(), gather=True):
    """Like `write_parquet`, into a new version of the folder, which is returned.

    Readers see the rows of before until the write is complete, and for ever if it fails. A
    version that nobody reads before it is complete needs no second renaming of its files.
    """
    spark = df.sparkSession
    folder = versions.new_version(spark, path)
    write_plain(_arranged(df, partition_by, order_by, gather), folder, partition_by)
    versions.drop_old(spark, path)
    return folder


def _arranged(df, partition_by, order_by, gather):
    partition_by, order_by = list(partition_by), list(order_by)
    if partition_by:
        if gather:
            df = df.hint("rebalance", *[F.col(name) for name in partition_by])
        if order_by:
            df = df.sortWithinPartitions(*partition_by, *order_by)
    elif order_by:
        df = df.orderBy(*[F.asc_nulls_last(name) for name in order_by])
    return df


def write_plain(df, path, partition_by=(), **options):
    """Write rows where they are, without moving or sorting them first."""
    writer = df.write.mode("overwrite").options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_csv(df, path):
    """Replace a CSV folder, every file with a header; blanks around text are kept."""
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").options(header=True, **keep).csv(path)
