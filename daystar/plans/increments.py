"""New days on top of a star that is there: neither its silver nor its facts are read again.

Changes of a new day need the last row of every series before it. These rows, the tails, are a
small table beside the star; appended rows are computed from the new feed and the tails.
"""

from __future__ import annotations

from daystar.operators import series
from daystar.operators.lookups import region_lookup
from daystar.plans import dims, facts, pipeline, silver
from daystar.sources import catalog, files, layout, scratch, versions

# By feed: silver table, its fact, and the counters that changes are taken of.
_FEEDS = {
    "cases": ("cases_standardized", "fact_cases_state_daily", ("cases_cum", "deaths_cum")),
    "tests": ("testing_standardized", "fact_testing_state_daily", ("tests_total_cum",)),
}
_FACTS = {"cases": facts.cases, "tests": facts.testing}


def tail_of(spark, base, feed):
    """The last row of every series of a silver table: as stored, or found by one pass over the table."""
    name, _, counters = _FEEDS[feed]
    path = f"{base}/tails/{name}"
    if versions.versions(spark, path):
        return files.read_parquet(spark, path)
    table = pipeline.silver_tables(spark, base)[name]
    return series.tail(table, *facts.series_of(table, counters), rows=1)


def new_fact(new, tail, feed):
    """Fact rows of new silver rows; reads these and the tail, nothing else."""
    return _FACTS[feed](new, before=tail)


def append_days(spark, base, feeds, prefix=None):
    """Append the days of `feeds` (folder with cases/ and tests/) to the star below `base`; returns the gold tables.

    Gives what a rebuild over all days gives. Rows that do not come after the last row of their series, such
    as corrections, are refused: they change days that are there and need a full `pipeline.run`.
    Tails are written first, so a job that died half-way is refused when it is run again, and never
    adds its rows twice. With `prefix` the registered tables follow.
    """
    lookup = region_lookup(files.read_csv(spark, f"{base}/bronze/static"))
    raw = {feed: files.read_csv(spark, f"{feeds}/{feed}") for feed in _FEEDS}
    typed = {
        "cases": silver.standardize_cases(raw["cases"], lookup),
        "tests": silver.standardize_tests(raw["tests"], lookup),
    }
    new, tails = {}, {}
    for feed, (name, _, counters) in _FEEDS.items():
        # Parsed once: what follows reads the new rows several times.
        path = scratch.new_folder(spark, name)
        files.write_plain(typed[feed], path)
        new[feed], tails[feed] = files.read_parquet(spark, path, typed[feed].schema), tail_of(spark, base, feed)
        keys, order = facts.series_of(new[feed], counters)
        if not series.late(new[feed], tails[feed], keys, order).isEmpty():
            raise ValueError(f"{feed}: rows that do not come after the last ones of their series")
    for feed, (name, _, counters) in _FEEDS.items():
        keys, order = facts.series_of(new[feed], counters)
        files.replace_parquet(series.tail(new[feed], keys, order, 1, before=tails[feed]), f"{base}/tails/{name}")
    for feed, (name, fact, _) in _FEEDS.items():
        # The tails of before are still there: a version stays until the one after the next is written.
        added = new_fact(new[feed], tails[feed], feed)
        _append(spark, new[feed], pipeline.silver_folder(spark, base, name))
        _append(spark, added, versions.current(spark, f"{base}/gold/{fact}"))
    gold = pipeline.gold_tables(spark, base)
    dates = gold["dim_date"].unionByName(dims.dim_date(*new.values())).dropDuplicates()
    regions = gold["dim_state"].unionByName(dims.dim_region(new["cases"])).dropDuplicates()
    files.replace_parquet(dates, f"{base}/gold/dim_date")
    files.replace_parquet(regions, f"{base}/gold/dim_state")
    if prefix is not None:
        _follow(spark, base, prefix, new)
    return pipeline.gold_tables(spark, base)


def _append(spark, df, folder):
    """Add files to a folder in the layout that it has; they show when the write commits."""
    parts = layout.partition_columns(spark, folder)
    if parts:
        df = df.hint("rebalance", *parts)
    writer = df.write.mode("append")
    (writer.partitionBy(*parts) if parts else writer).parquet(folder)


def _follow(spark, base, prefix, new):
    """Registered tables: partitions of the new rows, and the new versions of the dimensions."""
    _, silver_db, gold_db = (catalog.database(layer, prefix) for layer in catalog.LAYERS)
    for feed, (name, fact, _) in _FEEDS.items():
        for table, folder in (
            (f"{silver_db}.{name}", pipeline.silver_folder(spark, base, name)),
            (f"{gold_db}.{fact}", versions.current(spark, f"{base}/gold/{fact}")),
        ):
            catalog.add_partitions(spark, table, new[feed], folder)
    for name in ("dim_date", "dim_state"):
        schema = pipeline.gold_tables(spark, base)[name].schema
        catalog.register_parquet(spark, f"{gold_db}.{name}", schema, f"{base}/gold/{name}")
