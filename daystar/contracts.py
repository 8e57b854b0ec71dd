"""Column contracts of every table, bronze to published star."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "STRING": T.StringType(),
    "DATE": T.DateType(),
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "SMALLINT": T.ShortType(),
    "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
}


def _struct(columns, required=(), lengths=None):
    """Schema from `name TYPE, ...`; `lengths` turns text columns into bounded ones."""
    schema = T.StructType()
    for column in columns.split(","):
        name, kind = column.split()
        bound = (lengths or {}).get(name)
        data_type = T.VarcharType(bound) if bound else _TYPES[kind]
        schema = schema.add(name, data_type, name not in required)
    return schema


# Table schemas.
BRONZE_CASES = _struct("date STRING, state STRING, cases STRING, deaths STRING")
BRONZE_TESTS = _struct(
    "date STRING, state STRING, totalTestResults STRING, positive STRING, negative STRING"
)
BRONZE_LOOKUP = _struct("abbr STRING, name STRING")
BRONZE_FEED = _struct(
    "date STRING, state STRING, cases STRING, deaths STRING,"
    " new_cases STRING, new_deaths STRING"
)
BRONZE_REGIONS = _struct("state_code STRING, state_name STRING")
BRONZE_ABBREVIATIONS = _struct("state_code STRING, abbreviation STRING")

SILVER_CASES = _struct(
    "full_date DATE, state_code STRING, state_name STRING,"
    " cases_cum BIGINT, deaths_cum BIGINT, year INT, month INT, day INT"
)
SILVER_TESTS = _struct(
    "full_date DATE, state_code STRING, state_name STRING,"
    " tests_total_cum BIGINT, tests_pos_cum BIGINT, tests_neg_cum BIGINT,"
    " year INT, month INT, day INT"
)
SILVER_CASES_TEXT_KEY = _struct(
    "date_id STRING, state_code STRING, cases BIGINT, deaths BIGINT,"
    " year INT, month INT, day INT"
)
SILVER_TESTS_TEXT_KEY = _struct(
    "date_id STRING, state_code STRING, tests_total BIGINT, tests_positive BIGINT,"
    " tests_negative BIGINT, year INT, month INT, day INT"
)
SILVER_FEED = _struct(
    "date STRING, state STRING, cases BIGINT, deaths BIGINT,"
    " new_cases BIGINT, new_deaths BIGINT"
)

DIM_DATE = _struct(
    "date_id INT, full_date DATE, year INT, month INT, day INT, dow INT, is_weekend BOOLEAN"
)
DIM_STATE = _struct("state_code STRING, state_name STRING")
FACT_CASES = _struct(
    "date_id INT, state_code STRING, cases_cum BIGINT, deaths_cum BIGINT,"
    " new_cases BIGINT, new_deaths BIGINT"
)
FACT_TESTING = _struct(
    "date_id INT, state_code STRING, tests_total_cum BIGINT, tests_pos_cum BIGINT,"
    " tests_neg_cum BIGINT, new_tests BIGINT, positivity_rate DOUBLE"
)
FACT_FEED = _struct(
    "date STRING, state_name STRING, cases BIGINT, deaths BIGINT,"
    " new_cases BIGINT, new_deaths BIGINT"
)


def published_star(code_length=2, name_length=64):
    """Narrowed types of the published star, keyed by table name."""
    lengths = {"state_code": code_length, "state_name": name_length}
    return {
        "dim_date": _struct(
            "date_id INT, full_date DATE, year SMALLINT, month SMALLINT, day SMALLINT,"
            " dow SMALLINT, is_weekend BOOLEAN",
            required=["date_id"],
        ),
        "dim_state": _struct(
            "state_code STRING, state_name STRING", ["state_code"], lengths
        ),
        "fact_cases_state_daily": _struct(
            "date_id INT, state_code STRING, cases_cum BIGINT, deaths_cum BIGINT,"
            " new_cases INT, new_deaths INT",
            ["date_id", "state_code"],
            lengths,
        ),
        "fact_testing_state_daily": _struct(
            "date_id INT, state_code STRING, tests_total_cum BIGINT, tests_pos_cum BIGINT,"
            " tests_neg_cum BIGINT, new_tests INT, positivity_rate DOUBLE",
            ["date_id", "state_code"],
            lengths,
        ),
    }
