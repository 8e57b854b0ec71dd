"""Databases and tables in the session catalog."""

from __future__ import annotations

import uuid
from functools import reduce
from operator import and_
from urllib.parse import unquote

from pyspark.sql import functions as F

from daystar.sources import files, versions

# The three layers, one database each.
LAYERS = ("bronze", "silver", "gold")
# Fixed value: folder name of a partition without a value.
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
_SPECS_AT_ONCE = 100


def database(layer, prefix="daystar"):
    return f"{prefix}_{layer}"


def ensure_databases(spark, prefix="daystar", location=None):
    """Create the layer databases where missing, under `location` if given."""
    for layer in LAYERS:
        place = f" LOCATION {_text(f'{location}/{layer}')}" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_name(database(layer, prefix))}{place}")


def register_csv(spark, name, schema, path):
    """Table over a CSV folder, in place of an earlier one: columns by position, header skipped."""
    spark.sql(f"DROP TABLE IF EXISTS {_name(name)}")
    spark.sql(
        f"CREATE TABLE {_name(name)} ({_columns(schema)}) USING CSV"
        f" OPTIONS (header 'true', sep ',') LOCATION {_text(path)}"
    )


def register_parquet(spark, name, schema, path, partition_by=()):
    """Typed table over a Parquet folder, in place of an earlier one; finds its partitions.

    Of a versioned folder the newest complete version is taken. The new table is made ready beside
    the earlier one and then takes its name.
    """
    location = versions.current(spark, path)
    if not partition_by and _same_columns(spark, name, schema):
        spark.sql(f"ALTER TABLE {_name(name)} SET LOCATION {_text(location)}")
        return
    ready = f"{name}_{uuid.uuid4().hex[:8]}"
    parts = f" PARTITIONED BY ({', '.join(map(_name, partition_by))})" if partition_by else ""
    spark.sql(
        f"CREATE TABLE {_name(ready)} ({_columns(schema)}) USING PARQUET{parts}"
        f" LOCATION {_text(location)}"
    )
    if partition_by:
        repair(spark, ready)
    _rename(spark, ready, name)


def repair(spark, name):
    """Make all partitions below the table's folder visible; lists the whole of it."""
    spark.catalog.recoverPartitions(name)


def replace_table(df, name):
    """Rebuild a table from a query; its earlier rows stay readable until the new ones are complete.

    Rows go to a new version below the database's folder, and the table's location is switched
    to it: a failed job changes nothing, and the query may read the table itself.
    """
    spark = df.sparkSession
    root = _root(spark, name)
    files.replace_parquet(df, root)
    register_parquet(spark, name, df.schema, root)


def replace_bucketed(df, name, keys, buckets):
    """Rebuild a table whose rows are dealt to `buckets` files by `keys`, each in their order.

    Tables with the same buckets are joined on the keys without moving a row. One shuffle
    brings every bucket to one task, so there is one file per bucket.
    """
    spark = df.sparkSession
    folder = versions.new_version(spark, _root(spark, name))
    ready = f"{name}_{uuid.uuid4().hex[:8]}"
    dealt = df.repartition(buckets, *keys).sortWithinPartitions(*keys)
    dealt.write.option("path", folder).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(ready)
    _rename(spark, ready, name)
    versions.drop_old(spark, _root(spark, name))


def analyze(spark, name):
    """Have the catalog know a table's rows and size, by which the planner decides what to broadcast."""
    spark.sql(f"ANALYZE TABLE {_name(name)} COMPUTE STATISTICS")


def append_partitions(df, name):
    """Add rows to a partitioned table and make their partitions visible; returns how many these are.

    Rows go to a folder of their own below the table's, and only that folder is listed,
    however many partitions the table has. A partition that is there already is written anew with
    its old rows, and its location is switched; nothing of the earlier folders is changed.
    """
    spark = df.sparkSession
    columns = spark.catalog.listColumns(name)
    parts = [column.name for column in columns if column.isPartition]
    table = spark.table(name)
    df = df.select(*table.columns)
    # The catalog takes partitions one by one from the driver, so their list has to be there.
    fresh, present = [], []
    for spec in df.select(*parts).distinct().collect():
        (present if _is_partition(spark, name, spec) else fresh).append(spec)
    if present:
        df = df.unionByName(_of_partitions(table, parts, present))
    return _write_partitions(df, name, parts, fresh, present)


def add_partitions(spark, name, rows, folder):
    """Make the partitions of `rows` visible, whose files lie below `folder` in the usual places."""
    parts = [column.name for column in spark.catalog.listColumns(name) if column.isPartition]
    if parts:
        specs = [s for s in rows.select(*parts).distinct().collect() if not _is_partition(spark, name, s)]
        places = _partition_folders(spark, folder, len(parts)) if specs else {}
        for at in range(0, len(specs), _SPECS_AT_ONCE):
            added = " ".join(
                f"PARTITION ({_spec(s)}) LOCATION {_text(places[_values(s)])}"
                for s in specs[at : at + _SPECS_AT_ONCE]
            )
            spark.sql(f"ALTER TABLE {_name(name)} ADD {added}")
    spark.catalog.refreshTable(name)


def compact_partitions(spark, name, file_bytes=128 << 20):
    """Write anew those partitions that have more files than their size needs; returns how many these are.

    Sizes come from the files' own descriptions. A partition keeps its rows and gets a new
    location, which it has from one moment to the next; the others are not touched.
    """
    table = spark.table(name)
    parts = [column.name for column in spark.catalog.listColumns(name) if column.isPartition]
    listed = table.select(*parts, "_metadata.file_path", "_metadata.file_size").distinct()
    crowded = (
        listed.groupBy(*parts)
        .agg(F.count(F.lit(1)).alias("files"), F.sum("file_size").alias("bytes"))
        .where(F.col("files") > F.greatest(F.ceil(F.col("bytes") / file_bytes), F.lit(1)))
    )
    specs = crowded.select(*parts).collect()
    return _write_partitions(_of_partitions(table, parts, specs), name, parts, [], specs) if specs else 0


def _of_partitions(table, parts, specs):
    """Rows of the listed partitions; the list is as short as the catalog calls that follow from it."""
    listed = F.broadcast(table.sparkSession.createDataFrame(specs, table.select(*parts).schema))
    same = reduce(and_, [table[part].eqNullSafe(listed[part]) for part in parts])
    return table.join(listed, same, "left_semi")


def _write_partitions(df, name, parts, fresh, present):
    """Write partitions to a new folder below the table's, then add `fresh` ones and switch `present` ones."""
    if not fresh and not present:
        return 0
    spark = df.sparkSession
    folder = f"{_location(spark, name)}/batch-{uuid.uuid4().hex}"
    files.write_parquet(df, folder, parts)
    folders = _partition_folders(spark, folder, len(parts))
    for at in range(0, len(fresh), _SPECS_AT_ONCE):
        specs = fresh[at : at + _SPECS_AT_ONCE]
        added = " ".join(f"PARTITION ({_spec(s)}) LOCATION {_text(folders[_values(s)])}" for s in specs)
        spark.sql(f"ALTER TABLE {_name(name)} ADD {added}")
    for spec in present:
        place = _text(folders[_values(spec)])
        spark.sql(f"ALTER TABLE {_name(name)} PARTITION ({_spec(spec)}) SET LOCATION {place}")
    return len(fresh) + len(present)


def _partition_folders(spark, folder, depth):
    """{partition values as text: folder} of a written folder, listed level by level."""
    found = {(): folder}
    for _ in range(depth):
        found = {
            (*values, None if value == _NO_VALUE else unquote(value)): f"{place}/{name}"
            for values, place in found.items()
            for name in versions.children(spark, place)
            for _, equals, value in [name.partition("=")]
            if equals
        }
    return found


def _values(spec):
    """Partition values as the text of their folders."""
    return tuple(None if v is None else str(v).lower() if isinstance(v, bool) else str(v) for v in spec)


def _spec(spec):
    pairs = zip(spec.__fields__, _values(spec), strict=True)
    return ", ".join(f"{_name(name)} = {'NULL' if v is None else _text(v)}" for name, v in pairs)


def _is_partition(spark, name, spec):
    return not spark.sql(f"SHOW PARTITIONS {_name(name)} PARTITION ({_spec(spec)})").isEmpty()


def _rename(spark, ready, name):
    """Give a table that was made ready the name of another one, which goes; files of both stay."""
    spark.sql(f"DROP TABLE IF EXISTS {_name(name)}")
    spark.sql(f"ALTER TABLE {_name(ready)} RENAME TO {_name(name)}")


def _root(spark, name):
    """Folder of a table below its database's."""
    layer, own = name.rsplit(".", 1)
    return f"{spark.catalog.getDatabase(layer).locationUri.rstrip('/')}/{own}"


def _location(spark, name):
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {_name(name)}").where("col_name = 'Location'")
    return described.first()["data_type"].rstrip("/")


def _same_columns(spark, name, schema):
    if not spark.catalog.tableExists(name):
        return False
    kinds = [(f.name, f.dataType.simpleString()) for f in spark.table(name).schema.fields]
    return kinds == [(f.name, f.dataType.simpleString()) for f in schema.fields]


def _columns(schema):
    return ", ".join(f"{_name(f.name)} {f.dataType.simpleString()}" for f in schema.fields)


def _name(name):
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def _text(value):
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"
