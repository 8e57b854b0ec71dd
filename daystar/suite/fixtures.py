"""Feeds of the expected shape, derived from the given tables.

Orders play the cases feed (one region per customer nation), line items the tests
feed (one region per supplier nation), events the feeds with falling values. The
nations of one world region are left out of the lookup: they are the territories
that have no lookup row.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

TERRITORY_REGION = "MIDDLE EAST"


def _schema(longs="", ints="", texts="", doubles="", times=""):
    kinds = [
        (longs, T.LongType()),
        (ints, T.IntegerType()),
        (texts, T.StringType()),
        (doubles, T.DoubleType()),
        (times, T.TimestampNTZType()),
    ]
    return T.StructType(
        [T.StructField(name, kind) for names, kind in kinds for name in names.split()]
    )


# Schemas of the given tables, so that no job has to open a file to find them out.
SCHEMAS = {
    "region": _schema(ints="r_regionkey", texts="r_name"),
    "nation": _schema(ints="n_nationkey n_regionkey", texts="n_name"),
    "customer": _schema("c_custkey", "c_nationkey", "c_name c_mktsegment", "c_acctbal"),
    "supplier": _schema("s_suppkey", "s_nationkey", "s_name", "s_acctbal"),
    "part": _schema("p_partkey", "p_size", "p_name p_brand p_type", "p_retailprice"),
    "orders": _schema(
        "o_orderkey o_custkey",
        "",
        "o_orderstatus o_orderpriority",
        "o_totalprice",
        "o_orderdate",
    ),
    "lineitem": _schema(
        "l_orderkey l_partkey l_suppkey",
        "l_linenumber",
        "l_returnflag l_linestatus",
        "l_quantity l_extendedprice l_discount l_tax",
        "l_shipdate",
    ),
    "events": _schema("event_id user_id", "", "event_type props", "value", "ts"),
}


def table(spark, sf_dir, name):
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def nation_code(key):
    return F.concat(F.lit("N"), F.lpad(F.col(key).cast("string"), 2, "0"))


def lookup(spark, sf_dir):
    """Raw lookup `abbr, name`."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    known = region.where(F.col("r_name") != TERRITORY_REGION)
    return nation.join(known, nation.n_regionkey == known.r_regionkey, "left_semi").select(
        nation_code("n_nationkey").alias("abbr"), F.col("n_name").alias("name")
    )


def cases_daily(spark, sf_dir):
    """Orders per nation and day: `d, state, code, n, f`."""
    orders, customer, nation = (
        table(spark, sf_dir, name) for name in ("orders", "customer", "nation")
    )
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(
            F.col("o_orderdate").cast("date").alias("d"), F.col("n_name").alias("state"),
            F.col("n_nationkey"),
        )
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count(F.when(F.col("o_orderstatus") == "F", 1)).alias("f"),
        )
        .select("d", "state", nation_code("n_nationkey").alias("code"), "n", "f")
    )


def tests_daily(spark, sf_dir):
    """Line items per supplier nation and day: `d, state, n, p`."""
    lineitem, supplier = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "supplier")
    return (
        lineitem.join(supplier, lineitem.l_suppkey == supplier.s_suppkey)
        .groupBy(F.col("l_shipdate").cast("date").alias("d"), F.col("s_nationkey"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count(F.when(F.col("l_returnflag") == "R", 1)).alias("p"),
        )
        .select("d", nation_code("s_nationkey").alias("state"), "n", "p")
    )


def _running(column):
    # One row per nation and day comes in, so a nation has no more rows than days.
    window = Window.partitionBy("state").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    return F.sum(column).over(window).cast("string")


def cases(spark, sf_dir):
    """Raw cases feed: cumulative counters as text, names in lower case."""
    return cases_daily(spark, sf_dir).select(
        F.col("d").cast("string").alias("date"),
        F.lower("state").alias("state"),
        _running(F.col("n")).alias("cases"),
        _running(F.col("f")).alias("deaths"),
    )


def tests(spark, sf_dir):
    """Raw tests feed: compact dates, codes in lower case with a leading blank."""
    return tests_daily(spark, sf_dir).select(
        F.date_format("d", "yyyyMMdd").alias("date"),
        F.lower(F.concat(F.lit(" "), F.col("state"))).alias("state"),
        _running(F.col("n")).alias("totalTestResults"),
        _running(F.col("p")).alias("positive"),
        _running(F.col("n") - F.col("p")).alias("negative"),
    )


def cases_dirty(spark, sf_dir):
    """The cases feed with unreadable dates and counters, odd spellings and missing fields, by day of month."""
    day = F.dayofmonth(F.col("date").cast("date"))
    none = F.lit(None).cast("string")
    date = F.when(day == 3, F.translate("date", "-", "/")).when(day == 9, none).otherwise(F.col("date"))
    state = (
        F.when(day == 5, F.upper("state"))
        .when(day == 12, F.concat("state", F.lit(" ")))
        .when(day == 20, none)
        .otherwise(F.col("state"))
    )
    number = (
        F.when(day % 6 == 1, F.concat("cases", F.lit(".7")))
        .when(day % 6 == 2, "n/a")
        .when(day % 6 == 3, F.concat(F.lit(" "), "cases", F.lit(" ")))
        .when(day == 28, "")
        .otherwise(F.col("cases"))
    )
    deaths = (
        F.when(day % 4 == 0, none)
        .when(day % 7 == 5, F.concat(F.lit("-"), "deaths"))
        .when(day % 10 == 6, F.concat("deaths", F.lit("x")))
        .otherwise(F.col("deaths"))
    )
    return cases(spark, sf_dir).select(
        date.alias("date"), state.alias("state"), number.alias("cases"), deaths.alias("deaths")
    )


def tests_dirty(spark, sf_dir):
    """The tests feed with malformed dates and counters, zero totals and missing fields, by day of month."""
    day = F.substring("date", 7, 2).cast("int")
    none = F.lit(None).cast("string")
    year, month, rest = F.substring("date", 1, 4), F.substring("date", 5, 2), F.substring("date", 7, 2)
    date = (
        F.when(day == 4, F.concat_ws("-", year, month, rest))
        .when(day == 8, F.concat(year, F.lit("13"), rest))
        .when(day == 15, none)
        .otherwise(F.col("date"))
    )
    state = F.when(day == 6, F.concat("state", F.lit("  "))).when(day == 22, none).otherwise(F.col("state"))
    total = (
        F.when(day == 10, "0")
        .when(day == 17, "n/a")
        .when(day == 2, F.concat("totalTestResults", F.lit(".0")))
        .otherwise(F.col("totalTestResults"))
    )
    positive = F.when(day == 12, none).when(day == 18, "").otherwise(F.col("positive"))
    negative = F.when(day == 25, F.concat(F.lit("~"), "negative")).otherwise(F.col("negative"))
    return tests(spark, sf_dir).select(
        date.alias("date"),
        state.alias("state"),
        total.alias("totalTestResults"),
        positive.alias("positive"),
        negative.alias("negative"),
    )


def feed(spark, sf_dir):
    """Raw feed that carries daily changes; no deaths on a day read `n/a`."""
    return cases_daily(spark, sf_dir).select(
        F.col("d").cast("string").alias("date"),
        F.concat(F.lit(" "), F.col("code"), F.lit(" ")).alias("state"),
        _running(F.col("n")).alias("cases"),
        _running(F.col("f")).alias("deaths"),
        F.col("n").cast("string").alias("new_cases"),
        F.when(F.col("f") > 0, F.col("f").cast("string")).otherwise("n/a").alias("new_deaths"),
    )


def level(spark, sf_dir):
    """Values per user that rise and fall."""
    return table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")


def dense(spark, sf_dir):
    """Events per type and day, without gaps: `d, state, n`."""
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("ts").cast("date").alias("d"), F.col("event_type").alias("state"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
