"""The full job: bronze CSV to silver and gold Parquet, registered in the catalog.

Layout below `base`:

    bronze/cases, bronze/tests, bronze/static   CSV feeds and region lookup
    silver/cases_standardized, silver/testing_standardized
    gold/dim_date, gold/dim_state
    gold/fact_cases_state_daily, gold/fact_testing_state_daily

Stages hand over by written tables: each reads what the one before has stored, so
a lost executor costs a task and not the job, and no feed is parsed twice. Every refresh of a
silver or gold table is a new version of its folder (see `sources.versions`): readers have the
earlier rows until the new ones are complete, and keep them if the job dies.
"""

from __future__ import annotations

import argparse

from daystar import contracts
from daystar.operators import quality
from daystar.operators.lookups import region_lookup
from daystar.plans import dims, facts, publish, silver
from daystar.session import build_session
from daystar.sources import catalog, layout, versions
from daystar.sources.files import read_csv, read_parquet, replace_parquet, write_parquet

SILVER_PARTITIONS = ("state_code", "year", "month", "day")
SILVER_PARTITIONS_TEXT_KEY = ("year", "month", "day")
FACT_PARTITIONS = ("state_code",)
# Rows of a bucket of the facts that are dealt by key, at most.
BUCKET_ROWS = 2_000_000

_GOLD = {
    "dim_date": (contracts.DIM_DATE, ()),
    "dim_state": (contracts.DIM_STATE, ()),
    "fact_cases_state_daily": (contracts.FACT_CASES, FACT_PARTITIONS),
    "fact_testing_state_daily": (contracts.FACT_TESTING, FACT_PARTITIONS),
}
GOLD_TABLES = tuple(_GOLD)
_KEYS = {
    "dim_date": ["date_id"],
    "dim_state": ["state_code"],
    "fact_cases_state_daily": ["date_id", "state_code"],
    "fact_testing_state_daily": ["date_id", "state_code"],
}
_SILVER = {
    "cases_standardized": contracts.SILVER_CASES,
    "testing_standardized": contracts.SILVER_TESTS,
}


def run(
    spark,
    base,
    silver_partitions=SILVER_PARTITIONS,
    prefix="daystar",
    register=True,
    on_fault="report",
    least_rows=layout.LEAST_ROWS,
    quarantine=None,
):
    """Build silver and gold below `base` and register them; returns the gold tables.

    Of `silver_partitions` those leading ones become folders that hold `least_rows` rows on
    average, measured before silver is written; 0 makes them all folders. `quarantine="keys"` also
    stores the feeds' rows that silver cannot take, `"strict"` those with unreadable
    counters as well (see `quarantined`). The star is checked before anything is registered: faults are
    printed, or end the job under `on_fault="fail"`; `None` skips the checks.
    """
    build_silver(spark, base, silver_partitions, least_rows, quarantine)
    build_gold(spark, base)
    if on_fault is not None:
        _tell(faults(gold_tables(spark, base)), on_fault)
    if register:
        register_tables(spark, base, prefix)
    return gold_tables(spark, base)


def run_text_key(spark, base, partition_by=SILVER_PARTITIONS_TEXT_KEY):
    """The job with text date keys, signed changes and percentages; returns its gold tables."""
    build_silver_text_key(spark, base, partition_by)
    build_gold_text_key(spark, base)
    return {name: read_parquet(spark, f"{base}/gold/{name}") for name in _GOLD}


def faults(gold):
    """Number of faulty rows by check of a star: missing keys, repeated keys, facts without a date.

    One job that reads the key columns of every table once.
    """
    tables = {name: (gold[name], key) for name, key in _KEYS.items()}
    found = quality.key_faults(tables, parent="dim_date", by="date_id").collect()
    return {row["check"]: row["rows"] for row in found}


def _tell(found, on_fault):
    bad = {check: rows for check, rows in found.items() if rows}
    if bad and on_fault == "fail":
        raise ValueError(f"faults in the star: {bad}")
    for check, rows in bad.items():
        print(f"{check}: {rows}")


def build_silver(
    spark, base, partition_by=SILVER_PARTITIONS, least_rows=layout.LEAST_ROWS, quarantine=None
):
    """Typed cases and tests. With `quarantine` kept and other rows are written by the same job, each to its folder."""
    lookup = region_lookup(_bronze(spark, base, "static"))
    raw_cases, raw_tests = _bronze(spark, base, "cases"), _bronze(spark, base, "tests")
    if quarantine is None:
        cases = silver.standardize_cases(raw_cases, lookup)
        tests = silver.standardize_tests(raw_tests, lookup)
        always = ()
    else:
        strict = quarantine == "strict"
        cases = silver.checked_cases(raw_cases, lookup, strict)
        tests = silver.checked_tests(raw_tests, lookup, strict)
        always = ("status",)
    for name, table in (("cases_standardized", cases), ("testing_standardized", tests)):
        path = f"{base}/silver/{name}"
        layout.replace_planned(table, path, partition_by, least_rows, always=always)


def quarantined(spark, base, name):
    """Rows of a feed that its silver table did not take: `raw`, as they came, and `faults`."""
    folder = f"{versions.current(spark, f'{base}/silver/{name}')}/status=quarantined"
    if not versions.children(spark, folder):
        feed = {"cases_standardized": contracts.BRONZE_CASES, "testing_standardized": contracts.BRONZE_TESTS}
        kind = feed[name].simpleString()
        return spark.createDataFrame([], f"raw {kind}, faults array<string>")
    return spark.read.parquet(folder).select("raw", "faults")


def silver_folder(spark, base, name):
    """The folder of a silver table's rows, beside which there may be one of quarantined rows."""
    folder = versions.current(spark, f"{base}/silver/{name}")
    checked = any(child.startswith("status=") for child in versions.children(spark, folder))
    return f"{folder}/status=kept" if checked else folder


def build_silver_text_key(
    spark, base, partition_by=SILVER_PARTITIONS_TEXT_KEY, least_rows=layout.LEAST_ROWS
):
    """Silver with text date keys; regions without a code are kept, with the name they came by."""
    lookup = _bronze(spark, base, "static").selectExpr("abbr AS state_code", "name AS state_name")
    cases = silver.standardize_cases(
        _bronze(spark, base, "cases"),
        lookup,
        keep_unmatched=True,
        text_key=True,
        match="exact",
        keep_name=True,
    )
    tests = silver.standardize_tests(_bronze(spark, base, "tests"), text_key=True)
    layout.replace_planned(cases, f"{base}/silver/cases_standardized", partition_by, least_rows)
    layout.replace_planned(tests, f"{base}/silver/testing_standardized", partition_by, least_rows)


def build_gold(spark, base):
    tables = silver_tables(spark, base)
    cases, tests = tables["cases_standardized"], tables["testing_standardized"]
    replace_parquet(dims.dim_date(cases, tests), f"{base}/gold/dim_date")
    replace_parquet(dims.dim_region(cases), f"{base}/gold/dim_state")
    # The series of the facts leave a region's rows together and in date order, in
    # pieces if there are many: they are written as they come, without a second shuffle.
    for name, fact in [
        ("fact_cases_state_daily", facts.cases(cases)),
        ("fact_testing_state_daily", facts.testing(tests)),
    ]:
        replace_parquet(fact, f"{base}/gold/{name}", FACT_PARTITIONS, gather=False)


def build_gold_text_key(spark, base):
    """Gold of text-keyed silver: ordered dimensions, signed changes, rounded percentages."""
    cases = read_parquet(
        spark, f"{base}/silver/cases_standardized", silver.NAMED_CASES_TEXT_KEY
    )
    tests = read_parquet(
        spark, f"{base}/silver/testing_standardized", contracts.SILVER_TESTS_TEXT_KEY
    )
    replace_parquet(dims.dim_date_simple(cases), f"{base}/gold/dim_date")
    replace_parquet(dims.region_codes(cases), f"{base}/gold/dim_state")
    replace_parquet(
        facts.cases(cases, clamp=False, text_key=True), f"{base}/gold/fact_cases_state_daily"
    )
    replace_parquet(
        facts.testing(tests, clamp=False, text_key=True, as_percent=True),
        f"{base}/gold/fact_testing_state_daily",
    )


def silver_tables(spark, base):
    tables = {}
    for name, schema in _SILVER.items():
        folder = silver_folder(spark, base, name)
        # No row at all may have been kept.
        there = versions.children(spark, folder)
        tables[name] = read_parquet(spark, folder, schema) if there else spark.createDataFrame([], schema)
    return tables


def gold_tables(spark, base):
    return {
        name: read_parquet(spark, f"{base}/gold/{name}", schema)
        for name, (schema, _) in _GOLD.items()
    }


def register_tables(spark, base, prefix="daystar"):
    """Catalog tables over everything that `run` wrote, with the folders it has, and over the region lookup."""
    catalog.ensure_databases(spark, prefix)
    bronze, silver_db, gold = (catalog.database(layer, prefix) for layer in catalog.LAYERS)
    catalog.register_csv(
        spark, f"{bronze}.states_lookup", contracts.BRONZE_LOOKUP, f"{base}/bronze/static"
    )
    catalog.analyze(spark, f"{bronze}.states_lookup")
    for name, schema in _SILVER.items():
        path = silver_folder(spark, base, name)
        parts = layout.partition_columns(spark, path)
        catalog.register_parquet(spark, f"{silver_db}.{name}", schema, path, parts)
    for name, (schema, partition_by) in _GOLD.items():
        catalog.register_parquet(
            spark, f"{gold}.{name}", schema, f"{base}/gold/{name}", partition_by
        )
        if name.startswith("dim_"):
            catalog.analyze(spark, f"{gold}.{name}")


def bucket_facts(spark, base, prefix="daystar", bucket_rows=BUCKET_ROWS):
    """Registered copies of both facts, dealt by region and date, that are joined without a shuffle.

    They are for reports that join the facts again and again; the number of buckets follows from
    the larger one and is a power of two. Returns their names by fact.
    """
    catalog.ensure_databases(spark, prefix)
    gold, keys = gold_tables(spark, base), ["state_code", "date_id"]
    facts_of = [name for name in _GOLD if name.startswith("fact_")]
    rows = max(gold[name].count() for name in facts_of)
    buckets = 1 << max(-(-rows // bucket_rows) - 1, 0).bit_length()
    names = {name: f"{catalog.database('gold', prefix)}.{name}_by_key" for name in facts_of}
    for name, table in names.items():
        catalog.replace_bucketed(gold[name], table, keys, buckets)
    return names


def refresh_feed(
    spark, feed_path, regions_path, prefix="daystar", location=None, abbreviations_path=None
):
    """Rebuild silver and gold tables from a feed that already carries daily changes."""
    catalog.ensure_databases(spark, prefix, location)
    bronze, silver_db, gold = (catalog.database(layer, prefix) for layer in catalog.LAYERS)
    catalog.register_csv(spark, f"{bronze}.raw_cases", contracts.BRONZE_FEED, feed_path)
    catalog.register_csv(spark, f"{bronze}.raw_states", contracts.BRONZE_REGIONS, regions_path)
    if abbreviations_path:
        catalog.register_csv(
            spark,
            f"{bronze}.raw_state_abv",
            contracts.BRONZE_ABBREVIATIONS,
            abbreviations_path,
        )
    catalog.replace_table(
        silver.typed_copy(spark.table(f"{bronze}.raw_cases")), f"{silver_db}.silver_cases"
    )
    catalog.replace_table(spark.table(f"{bronze}.raw_states"), f"{silver_db}.silver_states")
    catalog.replace_table(
        facts.denormalised(
            spark.table(f"{silver_db}.silver_cases"), spark.table(f"{silver_db}.silver_states")
        ),
        f"{gold}.fact_feed_daily",
    )
    return spark.table(f"{gold}.fact_feed_daily")


def publish_star(spark, base, contract=None):
    """Write the narrowed star, laid out for serving, below `base/published`."""
    contract = contract or contracts.published_star()
    for name, table in gold_tables(spark, base).items():
        narrowed = publish.narrow(table, contract[name])
        if name.startswith("fact_"):
            narrowed = publish.layout(narrowed)
        elif name == "dim_date":
            narrowed = narrowed.orderBy("date_id")
        write_parquet(narrowed, f"{base}/published/{name}")


def _bronze(spark, base, name):
    return read_csv(spark, f"{base}/bronze/{name}")


def main(arguments=None):
    parser = argparse.ArgumentParser(description="Bronze to silver to gold.")
    parser.add_argument("--base", required=True, help="folder that holds bronze/")
    parser.add_argument("--prefix", default="daystar", help="prefix of the databases")
    parser.add_argument("--text-key", action="store_true", help="text date keys, signed changes")
    parser.add_argument("--publish", action="store_true", help="also write published/")
    parser.add_argument("--fail-on-fault", action="store_true", help="end when a check fails")
    parser.add_argument(
        "--catalog", choices=["in-memory", "hive"], default="in-memory", help="where tables live"
    )
    options = parser.parse_args(arguments)
    settings = {"spark.sql.catalogImplementation": options.catalog}
    spark = build_session("daystar-pipeline", settings=settings)
    if options.text_key:
        run_text_key(spark, options.base)
    else:
        on_fault = "fail" if options.fail_on_fault else "report"
        run(spark, options.base, prefix=options.prefix, on_fault=on_fault)
        if options.publish:
            publish_star(spark, options.base)
        if options.catalog == "in-memory":
            print("Tables are registered in this session only; use --catalog hive to keep them.")
    spark.stop()


if __name__ == "__main__":
    main()
