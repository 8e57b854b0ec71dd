from __future__ import annotations

from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daystar import functions as fn

# text, lenient value, strict value
NUMBERS = [
    ("12", 12, 12),
    ("12.0", 12, None),
    ("12.9", 12, None),
    ("-3.7", -3, None),
    ("7.", 7, None),
    (".5", 0, None),
    ("-.5", 0, None),
    ("", None, None),
    (" 7 ", 7, 7),
    ("\t7\n", 7, 7),
    ("+7", 7, 7),
    ("-", None, None),
    ("1e3", None, None),
    ("x", None, None),
    ("1.2.3", None, None),
    ("7 8", None, None),
    ("12345678901234567890", None, None),
    ("9223372036854775807", 9223372036854775807, 9223372036854775807),
    ("9223372036854775808", None, None),
    ("-9223372036854775808.5", -9223372036854775808, None),
    (None, None, None),
]


def values(df, column):
    return [row[0] for row in df.select(column).collect()]


def test_numbers(frame, ansi):
    df = frame("text string", *[row[0] for row in NUMBERS])
    assert values(df, fn.lenient_long("text")) == [row[1] for row in NUMBERS]
    assert values(df, fn.strict_long("text")) == [row[2] for row in NUMBERS]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="0123456789+-. \teEx", max_size=6), min_size=20, max_size=60))
def test_lenient_long_equals_cast_without_ansi(spark, texts):
    df = spark.createDataFrame([(text,) for text in texts], "text string")
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    legacy = values(df, F.col("text").cast("bigint"))
    spark.conf.set("spark.sql.ansi.enabled", before)
    assert values(df, fn.lenient_long("text")) == legacy


def test_iso_date(frame, ansi):
    df = frame("text string", "2020-05-01", "2020-13-01", "2020/05/01", "2020-5-1", "", None)
    expected = [date(2020, 5, 1), None, None, date(2020, 5, 1), None, None]
    assert values(df, fn.iso_date("text")) == expected


def test_compact_date(frame, ansi):
    df = frame("text string", "20200501", "20201301", "2020-05-01", "2020501", "20200230", None)
    assert values(df, fn.compact_date("text")) == [date(2020, 5, 1), *[None] * 5]
    assert values(frame("key int", 20200501), fn.compact_date("key")) == [date(2020, 5, 1)]


def test_date_keys_and_parts(frame):
    df = frame("d date, t string", (date(2020, 12, 31), "2020-12-31"), (None, None))
    assert values(df, fn.date_key("d")) == [20201231, None]
    assert values(df, fn.date_key_text("t")) == ["20201231", None]
    assert values(df, fn.date_label("d")) == ["2020-12-31", None]
    parts = df.select(*[c.alias(n) for n, c in fn.date_parts("d").items()]).first()
    assert parts.asDict() == {"year": 2020, "month": 12, "day": 31}
    text = df.select(fn.date_key_text("t").alias("k"))
    cut = text.select(*[c.alias(n) for n, c in fn.date_key_parts("k").items()]).first()
    assert cut.asDict() == {"year": "2020", "month": "12", "day": "31"}


def test_day_of_week(frame):
    df = frame("d date", date(2020, 5, 1), date(2020, 5, 2), date(2020, 5, 3), date(2020, 5, 4))
    assert values(df, fn.iso_dow("d")) == [5, 6, 7, 1]
    assert values(df, fn.is_weekend("d")) == [False, True, True, False]


def test_ratio_guards(frame, ansi):
    df = frame("a bigint, b bigint", (5, 10), (5, 0), (5, -1), (5, None), (None, 5))
    assert values(df, fn.ratio("a", "b")) == [0.5, None, None, None, None]
    assert values(df, fn.ratio("a", "b", guard="nonzero")) == [0.5, None, -5.0, None, None]
    with pytest.raises(ValueError):
        fn.ratio("a", "b", guard="none")


def test_percent_rounds_half_up(frame):
    df = frame("a bigint, b bigint", (1317, 4000), (1, 3), (1, 0))
    assert values(df, fn.percent("a", "b")) == [32.93, 33.33, None]


def test_text_keys(frame):
    df = frame("t string", " ny ", "district of columbia")
    assert values(df, fn.normalise_code("t"))[0] == "NY"
    assert values(df, fn.normalise_name("t"))[1] == "District Of Columbia"
