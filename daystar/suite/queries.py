"""Registered queries: one per operator, each over whole tables."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daystar import contracts
from daystar import functions as fn
from daystar.operators import lookups, quality, series
from daystar.plans import dims, facts, increments, marts, pipeline, publish, silver
from daystar.sources import catalog, files, layout, scratch
from daystar.suite import fixtures as fx
from daystar.suite import stored

QUERIES = {}

# Regions and dates that the single-region and single-day reports show.
REGION, REGIONS = "N03", ["N01", "N07", "N18"]
NAMES = ["Nation_1", "Nation_7", "Nation_18"]
DATE_ID = 19980817
# Published region codes are three letters wide here.
STAR = contracts.published_star(code_length=3)


def query(function):
    QUERIES[function.__name__] = function
    return function


# Inputs that several queries share


def _lookup(spark, sf):
    return lookups.region_lookup(fx.lookup(spark, sf))


def _exact_lookup(spark, sf):
    return fx.lookup(spark, sf).selectExpr("abbr AS state_code", "name AS state_name")


def _exact_cases(spark, sf):
    return fx.cases(spark, sf).withColumn("state", F.upper("state"))


def _regions(spark, sf):
    return fx.lookup(spark, sf).selectExpr("abbr AS state_code", "name AS state_name")


def _silver_cases(spark, sf, **options):
    return silver.standardize_cases(fx.cases(spark, sf), _lookup(spark, sf), **options)


def _silver_tests(spark, sf):
    return silver.standardize_tests(fx.tests(spark, sf), _lookup(spark, sf))


def _silver_cases_text(spark, sf, keep_name=False):
    return silver.standardize_cases(
        _exact_cases(spark, sf),
        _exact_lookup(spark, sf),
        keep_unmatched=True,
        text_key=True,
        match="exact",
        keep_name=keep_name,
    )


def _stored_cases(spark, sf):
    return stored.silver(spark, sf, "cases_standardized")


def _stored_tests(spark, sf):
    return stored.silver(spark, sf, "testing_standardized")


def _fact_cases(spark, sf):
    return stored.gold(spark, sf, "fact_cases_state_daily")


def _fact_tests(spark, sf):
    return stored.gold(spark, sf, "fact_testing_state_daily")


def _dim_date(spark, sf):
    return stored.gold(spark, sf, "dim_date")


def _fact_feed(spark, sf):
    return facts.denormalised(silver.typed_copy(fx.feed(spark, sf)), _regions(spark, sf))


def _dense_silver(spark, sf):
    return (
        fx.dense(spark, sf)
        .select(F.col("d").alias("full_date"), F.col("state").alias("state_code"), "n")
        .withColumns(fn.date_parts("full_date"))
    )


def _new_prefix():
    return f"daystar_{uuid.uuid4().hex[:12]}"


# Sources and scans


@query
def scan_csv(spark, sf):
    path = scratch.new_folder(spark, "scan_csv")
    files.write_csv(fx.cases(spark, sf), path)
    return files.read_csv(spark, path)


@query
def scan_csv_with_schema(spark, sf):
    path = scratch.new_folder(spark, "scan_csv")
    files.write_csv(fx.tests(spark, sf), path)
    return files.read_csv(spark, path, contracts.BRONZE_TESTS)


@query
def table_csv_positional(spark, sf):
    path, prefix = scratch.new_folder(spark, "feed"), _new_prefix()
    files.write_csv(fx.feed(spark, sf), path)
    catalog.ensure_databases(spark, prefix, scratch.new_folder(spark, "databases"))
    name = f"{catalog.database('bronze', prefix)}.raw_cases"
    catalog.register_csv(spark, name, contracts.BRONZE_FEED, path)
    return spark.table(name)


@query
def scan_parquet(spark, sf):
    path = scratch.new_folder(spark, "scan_parquet")
    files.write_parquet(_silver_cases(spark, sf), path, ["state_code"])
    return files.read_parquet(spark, path, contracts.SILVER_CASES)


@query
def scan_table_all(spark, sf):
    prefix = _new_prefix()
    catalog.ensure_databases(spark, prefix, scratch.new_folder(spark, "databases"))
    name = f"{catalog.database('gold', prefix)}.dim_date"
    catalog.replace_table(_dim_date(spark, sf), name)
    return spark.table(name).select("*")


@query
def region_lookup(spark, sf):
    return _lookup(spark, sf)


@query
def table_parquet_repaired(spark, sf):
    path, prefix = scratch.new_folder(spark, "dense"), _new_prefix()
    parts = ["state_code", "year", "month", "day"]
    dense = _dense_silver(spark, sf)
    files.write_parquet(dense, path, parts)
    catalog.ensure_databases(spark, prefix, scratch.new_folder(spark, "databases"))
    name = f"{catalog.database('silver', prefix)}.dense"
    catalog.register_parquet(spark, name, dense.schema, path, parts)
    return spark.table(name).select(*dense.columns)


# Sinks


def _written(spark, df, **options):
    path = scratch.new_folder(spark, "sink")
    files.write_parquet(df, path, **options)
    return files.read_parquet(spark, path, df.schema)


@query
def sink_parquet(spark, sf):
    return _written(spark, _dim_date(spark, sf))


@query
def sink_partitioned_by_day(spark, sf):
    return _written(
        spark, _dense_silver(spark, sf), partition_by=["state_code", "year", "month", "day"]
    )


@query
def sink_partitioned_by_date(spark, sf):
    return _written(spark, _dense_silver(spark, sf), partition_by=["year", "month", "day"])


@query
def sink_partitioned_by_region(spark, sf):
    return _written(
        spark, _fact_cases(spark, sf), partition_by=["state_code"], order_by=["date_id"]
    )


@query
def sink_sorted(spark, sf):
    return _written(spark, _dim_date(spark, sf), order_by=["date_id"])


@query
def sink_csv(spark, sf):
    path = scratch.new_folder(spark, "report")
    files.write_csv(_fact_cases(spark, sf), path)
    return files.read_csv(spark, path)


@query
def table_replaced(spark, sf):
    prefix = _new_prefix()
    catalog.ensure_databases(spark, prefix, scratch.new_folder(spark, "databases"))
    name = f"{catalog.database('silver', prefix)}.silver_cases"
    catalog.replace_table(fx.feed(spark, sf), name)
    catalog.replace_table(silver.typed_copy(fx.feed(spark, sf)), name)
    return spark.table(name)


@query
def publish_dim_date(spark, sf):
    return publish.narrow(_dim_date(spark, sf), STAR["dim_date"])


@query
def publish_dim_state(spark, sf):
    return publish.narrow(stored.gold(spark, sf, "dim_state"), STAR["dim_state"])


@query
def publish_fact_cases(spark, sf):
    return publish.narrow(_fact_cases(spark, sf), STAR["fact_cases_state_daily"])


@query
def publish_fact_testing(spark, sf):
    return publish.narrow(_fact_tests(spark, sf), STAR["fact_testing_state_daily"])


@query
def publish_layout(spark, sf):
    return publish.layout(_fact_tests(spark, sf))


# Projections, casts and scalar functions


@query
def project_fact(spark, sf):
    return _fact_cases(spark, sf).select("state_code", "date_id", "new_cases", "new_deaths")


@query
def rename_keys(spark, sf):
    return fx.tests(spark, sf).withColumnRenamed("state", "state_code")


def _numbers_as_text(spark, sf):
    """Order keys written plainly, padded, with decimals, or unreadably."""
    key, line = F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")
    text = (
        F.when(F.col("l_returnflag") == "A", F.concat(F.lit("-"), key, F.lit("."), line))
        .when(F.col("l_returnflag") == "R", F.concat(F.lit("x"), key))
        .when(F.col("l_linestatus") == "O", F.concat(F.lit(" "), key, F.lit(" ")))
        .otherwise(key)
    )
    lineitem = fx.table(spark, sf, "lineitem")
    return lineitem.select("l_orderkey", "l_linenumber", text.alias("text"))


@query
def cast_lenient_long(spark, sf):
    return _numbers_as_text(spark, sf).withColumn("value", fn.lenient_long("text"))


@query
def try_cast_long(spark, sf):
    return _numbers_as_text(spark, sf).withColumn("value", fn.strict_long("text"))


@query
def date_key_text(spark, sf):
    return fx.cases(spark, sf).select("date", "state", fn.date_key_text("date").alias("date_id"))


@query
def date_parts_text(spark, sf):
    return fx.tests(spark, sf).select("date", "state").withColumns(fn.date_key_parts("date"))


@query
def normalise_code(spark, sf):
    return fx.tests(spark, sf).select("date", "state", fn.normalise_code("state").alias("code"))


@query
def normalise_name(spark, sf):
    part = fx.table(spark, sf, "part")
    return part.select("p_partkey", fn.normalise_name("p_name").alias("name"))


def _dates_as_text(spark, sf):
    """Order dates as text, with slashes while an order is pending."""
    date = F.col("o_orderdate").cast("date").cast("string")
    slashed = F.regexp_replace(date, "-", "/")
    text = F.when(F.col("o_orderstatus") == "P", slashed).otherwise(date)
    return fx.table(spark, sf, "orders").select("o_orderkey", text.alias("text"))


@query
def parse_iso_date(spark, sf):
    return _dates_as_text(spark, sf).withColumn("date", fn.iso_date("text"))


@query
def parse_compact_date(spark, sf):
    return fx.tests(spark, sf).select("state", "date", fn.compact_date("date").alias("full_date"))


@query
def date_parts(spark, sf):
    date = F.col("o_orderdate").cast("date").alias("full_date")
    orders = fx.table(spark, sf, "orders").select("o_orderkey", date)
    return orders.withColumns(fn.date_parts("full_date"))


@query
def date_key_int(spark, sf):
    date = F.col("o_orderdate").cast("date")
    return fx.table(spark, sf, "orders").select("o_orderkey", fn.date_key(date).alias("date_id"))


@query
def date_label(spark, sf):
    date = fn.compact_date("date_id")
    return _fact_cases(spark, sf).select("state_code", "date_id", fn.date_label(date).alias("date"))


@query
def positivity_percent(spark, sf):
    rate = fn.percent("tests_pos_cum", "tests_total_cum").alias("positivity_rate")
    return _stored_tests(spark, sf).select("full_date", "state_code", rate)


# Filters


@query
def filter_region(spark, sf):
    return marts.filter_region(_fact_cases(spark, sf), REGION)


@query
def filter_date(spark, sf):
    return marts.filter_date(_fact_cases(spark, sf), DATE_ID)


@query
def filter_regions(spark, sf):
    return marts.filter_regions(_fact_cases(spark, sf), REGIONS)


@query
def resolve_region_names(spark, sf):
    return marts.resolve_regions(_fact_cases(spark, sf), _lookup(spark, sf), NAMES)


@query
def require_keys(spark, sf):
    kept = _silver_cases(spark, sf, keep_unmatched=True)
    return lookups.require(kept, ["full_date", "state_code"])


@query
def fill_null_zero(spark, sf):
    before = series.previous(
        fx.level(spark, sf), {"previous": "value"}, ["user_id"], ["ts", "event_id"]
    )
    return before.fillna({"previous": 0})


# Joins


@query
def left_join_name(spark, sf):
    return lookups.attach_region_by_name(fx.cases(spark, sf), _lookup(spark, sf))


@query
def left_join_exact(spark, sf):
    return lookups.attach_region_by_name(
        _exact_cases(spark, sf), _exact_lookup(spark, sf), match="exact"
    )


@query
def left_join_code(spark, sf):
    tests = fx.tests(spark, sf).withColumn("state_code", fn.normalise_code("state"))
    return lookups.attach_region_by_code(tests, _lookup(spark, sf))


@query
def left_join_trim(spark, sf):
    return lookups.attach_region_by_code(
        fx.feed(spark, sf), _regions(spark, sf), code="state", match="trim"
    )


@query
def join_fact_dim(spark, sf):
    return lookups.attach_region_by_code(_fact_tests(spark, sf), _lookup(spark, sf), how="inner")


@query
def join_fact_date(spark, sf):
    tests = _fact_tests(spark, sf).select("date_id", "state_code", "new_tests")
    return tests.join(_dim_date(spark, sf), "date_id")


@query
def join_fact_fact(spark, sf):
    return _fact_cases(spark, sf).join(_fact_tests(spark, sf), ["date_id", "state_code"])


@query
def orphan_dates(spark, sf):
    only_cases = dims.dim_date(_stored_cases(spark, sf))
    return quality.orphans(_fact_tests(spark, sf), only_cases, "date_id")


# Aggregates, distinct rows, set operations


@query
def distinct_multi(spark, sf):
    return _silver_cases_text(spark, sf).select("date_id", "year", "month", "day").distinct()


@query
def distinct_single(spark, sf):
    return _silver_cases_text(spark, sf).select("state_code").distinct()


@query
def dim_region(spark, sf):
    return dims.dim_region(_stored_cases(spark, sf))


@query
def qa_date_range(spark, sf):
    return quality.profile(_stored_cases(spark, sf))


@query
def qa_count_by_region(spark, sf):
    return quality.count_by(_stored_tests(spark, sf))


@query
def daily_total_new_cases(spark, sf):
    return marts.daily_total(_fact_feed(spark, sf))


@query
def top_regions_total(spark, sf):
    return marts.top_regions_total(_fact_feed(spark, sf))


@query
def top_regions_total_cumulative(spark, sf):
    return marts.top_regions_total(_fact_feed(spark, sf), mode="sum_cumulative")


@query
def duplicate_keys(spark, sf):
    return quality.duplicate_keys(fx.table(spark, sf, "events"), ["user_id", "event_type"])


@query
def union_dates(spark, sf):
    return dims.union_dates(_stored_cases(spark, sf), _stored_tests(spark, sf))


# Ordered series

_USER = {"keys": ["user_id"], "order_by": ["ts", "event_id"]}
_STATE = {"keys": ["state_code"], "order_by": ["date_id"]}


@query
def lag_previous(spark, sf):
    return series.previous(fx.level(spark, sf), {"previous": "value"}, **_USER)


@query
def daily_delta_clamped(spark, sf):
    return series.daily_delta(fx.level(spark, sf), {"delta": "value"}, **_USER)


@query
def daily_delta_signed(spark, sf):
    return series.daily_delta(fx.level(spark, sf), {"delta": "value"}, **_USER, clamp=False)


@query
def daily_delta_cut_series(spark, sf):
    """Every user's series cut into short pieces, as for a user with too many rows."""
    level = fx.level(spark, sf)
    return series.daily_delta(level, {"delta": "value"}, **_USER, clamp=False, hot_rows=10)


@query
def moving_avg_cut_series(spark, sf):
    """Every region's series cut into pieces, as for a region with too many rows."""
    return series.moving_avg(
        _fact_cases(spark, sf), {"new_cases_7day": "new_cases"}, **_STATE, hot_rows=50
    )


@query
def moving_avg_cases(spark, sf):
    averages = {"new_cases_7day": "new_cases"}
    return series.moving_avg(_fact_cases(spark, sf), averages, **_STATE)


@query
def moving_avg_positivity(spark, sf):
    averages = {"positivity_rate_7day": "positivity_rate"}
    return series.moving_avg(_fact_tests(spark, sf), averages, **_STATE)


@query
def first_n_per_region(spark, sf):
    return series.first_n(_fact_cases(spark, sf), **_STATE, n=marts.TREND_ROWS)


# Silver, dimension and fact tables


@query
def silver_cases(spark, sf):
    return _silver_cases(spark, sf)


@query
def silver_cases_text_key(spark, sf):
    return _silver_cases_text(spark, sf)


@query
def silver_tests(spark, sf):
    return _silver_tests(spark, sf)


@query
def silver_tests_text_key(spark, sf):
    return silver.standardize_tests(fx.tests(spark, sf), text_key=True)


@query
def silver_typed_copy(spark, sf):
    return silver.typed_copy(fx.feed(spark, sf))


@query
def dim_date(spark, sf):
    return dims.dim_date(_stored_cases(spark, sf), _stored_tests(spark, sf))


@query
def dim_date_simple(spark, sf):
    return dims.dim_date_simple(_silver_cases_text(spark, sf))


@query
def region_codes(spark, sf):
    return dims.region_codes(_silver_cases_text(spark, sf))


@query
def fact_cases(spark, sf):
    return facts.cases(_stored_cases(spark, sf))


@query
def fact_cases_signed(spark, sf):
    named = _silver_cases_text(spark, sf, keep_name=True)
    return facts.cases(named, clamp=False, text_key=True)


@query
def fact_testing(spark, sf):
    return facts.testing(_stored_tests(spark, sf))


@query
def fact_testing_percent(spark, sf):
    tests = silver.standardize_tests(fx.tests(spark, sf), text_key=True)
    return facts.testing(tests, clamp=False, text_key=True, as_percent=True)


@query
def fact_denormalised(spark, sf):
    return _fact_feed(spark, sf)


# Marts


@query
def sorted_lookup(spark, sf):
    return marts.region_list(_lookup(spark, sf))


@query
def cases_trend(spark, sf):
    return marts.cases_trend(_fact_cases(spark, sf), _lookup(spark, sf))


@query
def cases_trend_unlimited(spark, sf):
    return marts.cases_trend(_fact_cases(spark, sf), _lookup(spark, sf), limit=None)


@query
def cases_trend_limited(spark, sf):
    """The first rows of each region only, as a dashboard page shows them."""
    return marts.cases_trend(_fact_cases(spark, sf), _lookup(spark, sf), limit=marts.TREND_ROWS)


@query
def cases_trend_shared_code(spark, sf):
    """Two names for one code: each has the whole series of the code."""
    twice = _lookup(spark, sf).withColumn("state_name", F.concat("state_name", F.lit(" State")))
    both = _lookup(spark, sf).union(twice)
    return marts.cases_trend(_fact_cases(spark, sf), both)


@query
def testing_trend_limited(spark, sf):
    return marts.testing_trend(
        _fact_tests(spark, sf), _lookup(spark, sf), names=NAMES, limit=marts.TREND_ROWS
    )


@query
def testing_trend(spark, sf):
    return marts.testing_trend(_fact_tests(spark, sf), _lookup(spark, sf), names=NAMES)


@query
def combined_cases(spark, sf):
    return marts.combined(
        _fact_cases(spark, sf), _fact_tests(spark, sf), _lookup(spark, sf), NAMES
    )[0]


@query
def combined_tests(spark, sf):
    return marts.combined(_fact_cases(spark, sf), _fact_tests(spark, sf), _lookup(spark, sf))[1]


@query
def top_new_cases_on_date(spark, sf):
    return marts.top_n_on_date(_fact_cases(spark, sf), _lookup(spark, sf), DATE_ID)


@query
def top_positivity_on_date(spark, sf):
    return marts.top_n_on_date(
        _fact_tests(spark, sf), _lookup(spark, sf), DATE_ID, "positivity_rate"
    )


@query
def positivity_trend(spark, sf):
    return marts.positivity_trend(_fact_tests(spark, sf), _dim_date(spark, sf), REGION)


@query
def cases_vs_tests(spark, sf):
    return marts.cases_vs_tests(
        _fact_cases(spark, sf), _fact_tests(spark, sf), _dim_date(spark, sf)
    )


@query
def cases_vs_tests_of_region(spark, sf):
    return marts.cases_vs_tests(
        _fact_cases(spark, sf), _fact_tests(spark, sf), _dim_date(spark, sf), REGION
    )


@query
def cases_vs_tests_by_key(spark, sf):
    """The same report from facts that are stored dealt by region and date."""
    base, prefix = scratch.new_folder(spark, "by-key"), _new_prefix()
    catalog.ensure_databases(spark, prefix, f"{base}/databases")
    names = pipeline.bucket_facts(spark, stored.base(spark, sf), prefix, bucket_rows=5_000)
    cases, tests = (spark.table(names[f"fact_{name}_state_daily"]) for name in ("cases", "testing"))
    return marts.cases_vs_tests(cases, tests, _dim_date(spark, sf))


@query
def preview_dim_date(spark, sf):
    return marts.preview(_dim_date(spark, sf))


@query
def preview_ranges(spark, sf):
    """The first rows by date and region of a fact that is laid out in ranges of dates."""
    path = scratch.new_folder(spark, "ranges")
    dated = _fact_cases(spark, sf).withColumn("place", F.struct("date_id", "state_code"))
    layout.replace_ranges(dated, path, "place", range_rows=1000)
    return layout.first_rows(spark, path, dated.schema, "place", n=25).drop("place")


# Feeds with missing, malformed and oddly spelt fields


def _silver_dirty_cases(spark, sf):
    return silver.standardize_cases(fx.cases_dirty(spark, sf), _lookup(spark, sf))


def _silver_dirty_tests(spark, sf):
    return silver.standardize_tests(fx.tests_dirty(spark, sf), _lookup(spark, sf))


@query
def silver_cases_dirty(spark, sf):
    return _silver_dirty_cases(spark, sf)


@query
def silver_tests_dirty(spark, sf):
    return _silver_dirty_tests(spark, sf)


@query
def fact_cases_dirty(spark, sf):
    return facts.cases(_silver_dirty_cases(spark, sf))


@query
def fact_testing_dirty(spark, sf):
    return facts.testing(_silver_dirty_tests(spark, sf))


@query
def moving_avg_dirty(spark, sf):
    fact = facts.testing(_silver_dirty_tests(spark, sf))
    return series.moving_avg(fact, {"positivity_rate_7day": "positivity_rate"}, **_STATE)


@query
def parse_compact_date_malformed(spark, sf):
    dirty = fx.tests_dirty(spark, sf)
    return dirty.select("state", "date", fn.compact_date("date").alias("full_date"))


def _checked_silver(spark, sf, quarantine):
    """Folder of silver from the dirty feeds, kept and quarantined rows from one write each."""
    base = scratch.new_folder(spark, "checked")
    files.write_csv(fx.cases_dirty(spark, sf), f"{base}/bronze/cases")
    files.write_csv(fx.tests_dirty(spark, sf), f"{base}/bronze/tests")
    files.write_csv(fx.lookup(spark, sf), f"{base}/bronze/static")
    pipeline.build_silver(spark, base, quarantine=quarantine)
    return base


def _rejected(spark, base, name):
    return pipeline.quarantined(spark, base, name).select(
        "raw.*", F.array_join("faults", ",").alias("faults")
    )


@query
def quarantined_cases(spark, sf):
    """Rows without a readable date or a known region, as they came."""
    return _rejected(spark, _checked_silver(spark, sf, "keys"), "cases_standardized")


@query
def quarantined_tests_strict(spark, sf):
    """Rows that miss a key, and those whose counters are there but no numbers."""
    return _rejected(spark, _checked_silver(spark, sf, "strict"), "testing_standardized")


@query
def quarantine_balance(spark, sf):
    """Rows read, kept and quarantined of both feeds under the strict rule."""
    base = _checked_silver(spark, sf, "strict")
    kept, parts = pipeline.silver_tables(spark, base), []
    for feed, name in (("cases", "cases_standardized"), ("tests", "testing_standardized")):
        read = files.read_csv(spark, f"{base}/bronze/{feed}")
        tagged = [("read", read), ("kept", kept[name]), ("quarantined", pipeline.quarantined(spark, base, name))]
        parts += [df.select(F.lit(feed).alias("feed"), F.lit(tag).alias("tag")) for tag, df in tagged]
    rows = reduce(DataFrame.unionByName, parts)
    counts = [F.count_if(F.col("tag") == tag).alias(tag) for tag in ("read", "kept", "quarantined")]
    return rows.groupBy("feed").agg(*counts)


# Quality


@query
def null_violations(spark, sf):
    return quality.null_violations(
        _silver_cases(spark, sf, keep_unmatched=True), ["full_date", "state_code"]
    )


@query
def too_long(spark, sf):
    return quality.too_long(fx.table(spark, sf, "nation"), {"n_name": 8})


@query
def negative_deltas(spark, sf):
    deltas = series.daily_delta(fx.level(spark, sf), {"delta": "value"}, **_USER, clamp=False)
    return quality.negatives(deltas, ["delta"])


@query
def unmatched_names(spark, sf):
    return quality.unmatched(fx.cases(spark, sf), _lookup(spark, sf))


# Whole jobs


@query
def pipeline_text_key(spark, sf):
    """The job with text date keys, silver by year; gives its cases fact."""
    base = scratch.new_folder(spark, "pipeline")
    files.write_csv(_exact_cases(spark, sf), f"{base}/bronze/cases")
    files.write_csv(fx.tests(spark, sf), f"{base}/bronze/tests")
    files.write_csv(fx.lookup(spark, sf), f"{base}/bronze/static")
    return pipeline.run_text_key(spark, base, ("year",))["fact_cases_state_daily"]


@query
def pipeline_published(spark, sf):
    """The published star as stored: the cases fact in its narrowed types."""
    base = scratch.new_folder(spark, "pipeline")
    stored.write_bronze(spark, sf, base)
    pipeline.run(spark, base, ("state_code",), register=False)
    pipeline.publish_star(spark, base, STAR)
    return files.read_parquet(spark, f"{base}/published/fact_cases_state_daily")


@query
def star_faults(spark, sf):
    """Rows by check of the stored star."""
    gold = {name: stored.gold(spark, sf, name) for name in pipeline.GOLD_TABLES}
    rows = list(pipeline.faults(gold).items())
    return spark.createDataFrame(rows, "check string, rows bigint")


@query
def emptiness(spark, sf):
    """Whether facts of a region have rows, for one that is there and one that is not."""
    cases, tests = _fact_cases(spark, sf), _fact_tests(spark, sf)
    none = marts.filter_region(cases, "no such region")
    row = (quality.both_present(cases, tests), quality.is_empty(none))
    return spark.createDataFrame([row], "both_present boolean, none_is_empty boolean")


@query
def filter_date_text_key(spark, sf):
    return marts.filter_date(_silver_cases_text(spark, sf), DATE_ID)


@query
def daily_delta_cut_dashed_text(spark, sf):
    """Series cut along dates written with dashes, which share their leading digits."""
    dense = fx.dense(spark, sf).select(F.col("d").cast("string").alias("day"), "state", "n")
    return series.daily_delta(dense, {"delta": "n"}, ["state"], ["day"], clamp=False, hot_rows=5)


@query
def pipeline_star(spark, sf):
    """Bronze to gold through written tables; gives the testing fact of the catalog."""
    base, prefix = scratch.new_folder(spark, "pipeline"), _new_prefix()
    stored.write_bronze(spark, sf, base)
    catalog.ensure_databases(spark, prefix, f"{base}/databases")
    pipeline.run(spark, base, silver_partitions=("state_code",), prefix=prefix)
    fact = spark.table(f"{catalog.database('gold', prefix)}.fact_testing_state_daily")
    return fact.select(*contracts.FACT_TESTING.fieldNames())


@query
def pipeline_default(spark, sf):
    """The job as it runs without any options: silver by region and day as far as folders are worth it."""
    base, prefix = scratch.new_folder(spark, "pipeline"), _new_prefix()
    stored.write_bronze(spark, sf, base)
    catalog.ensure_databases(spark, prefix, f"{base}/databases")
    pipeline.run(spark, base, prefix=prefix)
    fact = spark.table(f"{catalog.database('gold', prefix)}.fact_cases_state_daily")
    return fact.select(*contracts.FACT_CASES.fieldNames())


@query
def appended_days(spark, sf):
    """A star of the days before 1998, to which the later days are appended in two steps; its testing fact."""
    base = scratch.new_folder(spark, "appended")
    feeds = {"cases": fx.cases(spark, sf), "tests": fx.tests(spark, sf)}
    files.write_csv(fx.lookup(spark, sf), f"{base}/bronze/static")
    # Dates are texts of either form here; their digits sort alike.
    day = F.translate("date", "-", "")
    spans = {"bronze": day < "19980101", "first": day.between("19980101", "19980630"), "second": day > "19980630"}
    for folder, span in spans.items():
        for name, feed in feeds.items():
            files.write_csv(feed.where(span), f"{base}/{folder}/{name}")
    pipeline.run(spark, base, register=False)
    increments.append_days(spark, base, f"{base}/first")
    return increments.append_days(spark, base, f"{base}/second")["fact_testing_state_daily"]


@query
def layout_by_day(spark, sf):
    """Folders and files of a table with a folder per region and day, as planned: one file each."""
    path = scratch.new_folder(spark, "layout")
    parts = list(pipeline.SILVER_PARTITIONS)
    layout.replace_planned(_dense_silver(spark, sf), path, parts, least_rows=0)
    return layout.folder_report(spark, path).select("folders", "files")


@query
def appended_partitions(spark, sf):
    """A table that gets its years one after the other, then is compacted."""
    path, prefix = scratch.new_folder(spark, "appended"), _new_prefix()
    cases, parts = _stored_cases(spark, sf), ["year"]
    files.replace_parquet(cases.where("year <= 1993"), path, parts)
    catalog.ensure_databases(spark, prefix, scratch.new_folder(spark, "databases"))
    name = f"{catalog.database('silver', prefix)}.cases"
    catalog.register_parquet(spark, name, cases.schema, path, parts)
    # The year that is there already is merged, the later ones are new.
    for months in ("year = 1994 AND month <= 6", "year = 1994 AND month > 6 OR year > 1994"):
        catalog.append_partitions(cases.where(months), name)
    catalog.compact_partitions(spark, name)
    return spark.table(name).select(*cases.columns)


@query
def pipeline_feed(spark, sf):
    """Second refresh of the tables built from the feed that carries daily changes.

    The first one reads another folder, with fewer rows; nothing of it may stay.
    """
    base, prefix = scratch.new_folder(spark, "refresh"), _new_prefix()
    feed = fx.feed(spark, sf)
    files.write_csv(feed.where(F.col("state") == REGION), f"{base}/earlier")
    files.write_csv(feed, f"{base}/feed")
    files.write_csv(_regions(spark, sf), f"{base}/regions")
    pipeline.refresh_feed(spark, f"{base}/earlier", f"{base}/regions", prefix, f"{base}/databases")
    return pipeline.refresh_feed(
        spark, f"{base}/feed", f"{base}/regions", prefix, f"{base}/databases"
    )
