"""Series operators against a plain loop, with series whole and cut into pieces."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from daystar.operators import series

START = date(2020, 1, 1)


def skewed_rows(seed=7):
    """One key holds most rows; days have gaps; some values are missing."""
    random.seed(seed)
    rows = []
    for key, length in [("hot", 400), ("b", 40), ("c", 7), ("d", 1)]:
        day = START
        for _ in range(length):
            day += timedelta(days=random.choice([1, 1, 1, 2, 40]))
            value = None if random.random() < 0.1 else random.randint(0, 100)
            rows.append((key, day, value))
    return rows


def expected(rows, keys=1, width=7):
    result = []
    for key in {row[0] for row in rows}:
        own = sorted(row for row in rows if row[0] == key)
        for i, (_, day, value) in enumerate(own):
            before = own[i - 1][2] if i else None
            step = None if value is None or before is None else value - before
            last = [row[2] for row in own[max(0, i - width + 1) : i + 1]]
            full = len(last) == width and None not in last
            result.append(
                (
                    key,
                    day,
                    value,
                    before,
                    max(step or 0, 0),
                    step or 0,
                    sum(last) / width if full else None,
                )
            )
    return sorted(result, key=str)


def computed(df, order, hot_rows):
    spec = {"keys": ["k"], "order_by": order, "hot_rows": hot_rows}
    results = [
        series.previous(df, {"before": "v"}, **spec),
        series.daily_delta(df, {"clamped": "v"}, **spec),
        series.daily_delta(df, {"signed": "v"}, **spec, clamp=False),
        series.moving_avg(df, {"mean": "v"}, **spec),
    ]
    rows = {}
    for result in results:
        for key, day, value, new in result.collect():
            rows.setdefault((key, day, value), []).append(new)
    return sorted(((*row, *new) for row, new in rows.items()), key=str)


@pytest.mark.parametrize("hot_rows", [None, 1000, 50, 3])
def test_equals_a_plain_loop(spark, hot_rows):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, "k string, d date, v bigint")
    assert computed(df, ["d"], hot_rows) == expected(rows)


AXES = {
    "bigint": lambda d: d.toordinal(),
    "string": lambda d: d.strftime("%Y%m%d"),
    "timestamp": lambda d: datetime(d.year, d.month, d.day, 3, 4, 5),
    "timestamp_ntz": lambda d: datetime(d.year, d.month, d.day, 3, 4, 5),
    "decimal(12,2)": lambda d: Decimal(d.toordinal()),
}


@pytest.mark.parametrize("kind", AXES)
def test_every_type_of_axis(spark, kind):
    rows = [(key, AXES[kind](day), value) for key, day, value in skewed_rows(3)]
    df = spark.createDataFrame(rows, f"k string, d {kind}, v bigint")
    mean = series.moving_avg(df, {"m": "v"}, ["k"], ["d"], hot_rows=20).collect()
    whole = series.moving_avg(df, {"m": "v"}, ["k"], ["d"], hot_rows=None).collect()
    assert sorted(map(tuple, mean), key=str) == sorted(map(tuple, whole), key=str)


def test_unreadable_text_keys_keep_their_place(spark):
    keys = ["", "19991231", "2020", "20200101", "20200102x", "2020-01-03", "20200228", "abc", "~"]
    keys += [f"2020{m:02d}15" for m in range(3, 13)] + [f"2021/{m:02d}" for m in range(1, 9)]
    df = spark.createDataFrame([("k", k, i) for i, k in enumerate(keys)], "k string, d string, v int")
    cut, whole = (
        series.previous(df, {"before": "d"}, ["k"], ["d"], hot_rows=rows).collect()
        for rows in (2, None)
    )
    assert sorted(map(tuple, cut), key=str) == sorted(map(tuple, whole), key=str)


def test_missing_keys_and_positions(spark):
    rows = [(None, START + timedelta(days=i), i) for i in range(30)] + [("a", None, 1), ("a", START, 2)]
    df = spark.createDataFrame(rows, "k string, d date, v int")
    cut, whole = (
        series.previous(df, {"before": "v"}, ["k"], ["d"], hot_rows=rows_).collect()
        for rows_ in (1, None)
    )
    assert sorted(map(tuple, cut), key=str) == sorted(map(tuple, whole), key=str)
    assert len(cut) == 32


def test_several_keys_and_order_columns(spark):
    rows = [(i % 2, "x", START + timedelta(days=i // 9), i, i * i % 17) for i in range(200)]
    df = spark.createDataFrame(rows, "a int, b string, d date, e int, v int")
    cut, whole = (
        series.moving_avg(df, {"m": "v"}, ["a", "b"], ["d", "e"], rows=3, hot_rows=n).collect()
        for n in (4, None)
    )
    assert sorted(map(tuple, cut), key=str) == sorted(map(tuple, whole), key=str)


HARD_TO_CUT = {
    "one outlier": ("date", lambda i: date(1, 1, 1) if i == 7 else START + timedelta(days=i % 5000), ["d", "v"]),
    "dashed text": ("string", lambda i: (START + timedelta(days=i % 3000)).isoformat(), ["d", "v"]),
    "other text": ("string", lambda i: f"week {i % 4000:04d}", ["d", "v"]),
    "one date": ("date", lambda i: START, ["d", "v"]),
    "two equal columns": ("date", lambda i: START, ["d", "k", "v"]),
}


@pytest.mark.parametrize("case", HARD_TO_CUT)
def test_pieces_are_even_whatever_the_order_looks_like(spark, case):
    kind, value, order = HARD_TO_CUT[case]
    rows = [("hot", value(i), i) for i in range(20_000)] + [("cold", value(1), 1)]
    df = spark.createDataFrame(rows, f"k string, d {kind}, v bigint")
    pieces = series._cut(df, df.columns, ["k"], order, 1000).groupBy("k", series._PIECE).count()
    sizes = {(row.k, row[series._PIECE]): row["count"] for row in pieces.collect()}
    assert sizes.pop(("cold", series._WHOLE)) == 1
    assert max(sizes.values()) <= 2000 and len(sizes) >= 12
    cut, whole = (
        series.previous(df, {"before": "v"}, ["k"], order, hot_rows=n).collect() for n in (1000, None)
    )
    assert sorted(map(tuple, cut), key=str) == sorted(map(tuple, whole), key=str)


def test_hot_series_spreads_over_pieces(spark):
    """A key with nearly all rows is no single group any more."""
    days = spark.range(20_000).select(
        F.when(F.col("id") % 50 == 0, "cold").otherwise("hot").alias("k"),
        F.date_add(F.lit(START), (F.col("id") / 4).cast("int")).alias("d"),
        F.col("id").alias("v"),
    )
    pieces = series._cut(days, days.columns, ["k"], ["d", "v"], 1000).groupBy("k", series._PIECE).count().collect()
    assert {row["count"] for row in pieces if row.k == "cold"} == {400}
    assert max(row["count"] for row in pieces) <= 2000


def test_daily_delta_examples(frame):
    df = frame("k string, d int, v bigint", ("a", 1, 10), ("a", 2, 8), ("a", 3, 12))
    spec = {"keys": ["k"], "order_by": ["d"]}
    clamped = series.daily_delta(df, {"x": "v"}, **spec).orderBy("d").collect()
    signed = series.daily_delta(df, {"x": "v"}, **spec, clamp=False).orderBy("d").collect()
    assert [row.x for row in clamped] == [0, 0, 4]
    assert [row.x for row in signed] == [0, -2, 4]


def test_moving_avg_examples(frame):
    rows = [("a", i, None if i == 4 else i) for i in range(1, 13)]
    df = frame("k string, d int, v int", *rows)
    means = series.moving_avg(df, {"m": "v"}, ["k"], ["d"]).orderBy("d").collect()
    assert [row.m for row in means] == [None] * 10 + [8.0, 9.0]
    short = series.moving_avg(df.where("d <= 6"), {"m": "v"}, ["k"], ["d"]).collect()
    assert [row.m for row in short] == [None] * 6


def test_first_n(spark):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, "k string, d date, v bigint")
    taken = series.first_n(df, ["k"], ["d"], 25).collect()
    firsts = [row for key in {r[0] for r in rows} for row in sorted(r for r in rows if r[0] == key)[:25]]
    assert sorted(map(tuple, taken), key=str) == sorted(firsts, key=str)
