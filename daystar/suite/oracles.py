"""SQL for each registered query, on the given tables and nothing else."""

from __future__ import annotations

from daystar.suite.fixtures import TERRITORY_REGION
from daystar.suite.queries import DATE_ID, NAMES, REGION, REGIONS


def _code(key):
    return f"concat('N', lpad(cast({key} AS varchar), 2, '0'))"


def _initcap(text):
    return f"concat(upper(substr({text}, 1, 1)), lower(substr({text}, 2)))"


def _date_id(date):
    return f"cast(year({date}) * 10000 + month({date}) * 100 + day({date}) AS integer)"


def _parts(date):
    return ", ".join(f"cast({p}({date}) AS integer) AS {p}" for p in ("year", "month", "day"))


def _text_parts(key, kind="integer"):
    cuts = {"year": "1, 4", "month": "5, 2", "day": "7, 2"}
    return ", ".join(f"cast(substr({key}, {c}) AS {kind}) AS {p}" for p, c in cuts.items())


def _running(count):
    total = f"sum({count}) OVER (PARTITION BY state ORDER BY d)"
    return f"cast(cast({total} AS bigint) AS varchar)"


def _round2(number):
    """Half up on the decimal text of a double."""
    return f"cast(round(cast(cast({number} AS varchar) AS decimal(38, 20)), 2) AS double)"


def _delta(column, clamp, order="full_date", key="state_code"):
    step = f"{column} - lag({column}) OVER (PARTITION BY {key} ORDER BY {order})"
    return f"greatest({step}, 0)" if clamp else f"coalesce({step}, 0)"


def _average(column, key="state_code"):
    """Mean of seven rows, added up oldest first; NULL if one is missing."""
    over = f"OVER (PARTITION BY {key} ORDER BY date_id)"
    rows = [f"lag({column}, {back}) {over}" for back in range(6, 0, -1)] + [column]
    return f"cast({' + '.join(rows)} AS double) / 7 AS {column}_7day"


def _lenient(text):
    """Whole number of a text, cut at its point."""
    return (
        f"CASE WHEN regexp_full_match(trim({text}), '[+-]?[0-9]+([.][0-9]*)?')"
        f" THEN cast(regexp_extract(trim({text}), '^[+-]?[0-9]+') AS bigint) END"
    )


def _unreadable(columns):
    """Names of columns, by name, whose text is there but no number."""
    return [
        f"CASE WHEN {_lenient(name)} IS NULL AND trim({name}) <> '' THEN '{name}' END" for name in columns
    ]


_LABEL = "strftime(strptime(cast(date_id AS varchar), '%Y%m%d'), '%Y-%m-%d')"
_POSITIVITY = "cast(tests_pos_cum AS double) / nullif(tests_total_cum, 0) AS positivity_rate"
_RATE = "CASE WHEN tests_total_cum > 0 THEN tests_pos_cum / tests_total_cum END"
_BY_USER = "OVER (PARTITION BY user_id ORDER BY ts, event_id)"
_LEVEL_DELTA = f"coalesce(value - lag(value) {_BY_USER}, 0)"
_NAMES = ", ".join(f"'{name}'" for name in NAMES)
_REGIONS = ", ".join(f"'{code}'" for code in REGIONS)

_TABLES = {
    "lookup": f"""
        SELECT {_code("n_nationkey")} AS abbr, n_name AS name
        FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> '{TERRITORY_REGION}'
    """,
    "cases_daily": f"""
        SELECT cast(o_orderdate AS date) AS d, n_name AS state,
               {_code("n_nationkey")} AS code, count(*) AS n,
               sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS f
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        GROUP BY 1, 2, 3
    """,
    "cases": f"""
        SELECT cast(d AS varchar) AS date, lower(state) AS state,
               {_running("n")} AS cases, {_running("f")} AS deaths
        FROM cases_daily
    """,
    "tests_daily": f"""
        SELECT cast(l_shipdate AS date) AS d, {_code("s_nationkey")} AS state,
               count(*) AS n, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS p
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
        GROUP BY 1, 2
    """,
    "tests": f"""
        SELECT replace(cast(d AS varchar), '-', '') AS date, lower(concat(' ', state)) AS state,
               {_running("n")} AS totalTestResults, {_running("p")} AS positive,
               {_running("n - p")} AS negative
        FROM tests_daily
    """,
    "feed": f"""
        SELECT cast(d AS varchar) AS date, concat(' ', code, ' ') AS state,
               {_running("n")} AS cases, {_running("f")} AS deaths,
               cast(n AS varchar) AS new_cases,
               CASE WHEN f > 0 THEN cast(f AS varchar) ELSE 'n/a' END AS new_deaths
        FROM cases_daily
    """,
    "level": "SELECT event_id, ts, user_id, value FROM events",
    "dense": f"""
        SELECT full_date, state_code, count(*) AS n, {_parts("full_date")}
        FROM (SELECT cast(ts AS date) AS full_date, event_type AS state_code FROM events)
        GROUP BY full_date, state_code
    """,
    "clean_lookup": f"""
        SELECT upper(trim(abbr)) AS state_code, {_initcap("name")} AS state_name FROM lookup
    """,
    "silver_cases_kept": f"""
        SELECT cast(date AS date) AS full_date, state_code, state_name,
               cast(cases AS bigint) AS cases_cum, cast(deaths AS bigint) AS deaths_cum,
               {_parts("cast(date AS date)")}
        FROM cases LEFT JOIN clean_lookup ON {_initcap("state")} = state_name
    """,
    "silver_cases": "SELECT * FROM silver_cases_kept WHERE state_code IS NOT NULL",
    "silver_cases_text": f"""
        SELECT replace(date, '-', '') AS date_id, abbr AS state_code,
               cast(cases AS bigint) AS cases, cast(deaths AS bigint) AS deaths,
               {_text_parts("replace(date, '-', '')")}
        FROM cases LEFT JOIN lookup ON upper(state) = name
    """,
    "silver_cases_named": """
        SELECT replace(date, '-', '') AS date_id, abbr AS state_code, upper(state) AS state_name,
               cast(cases AS bigint) AS cases, cast(deaths AS bigint) AS deaths
        FROM cases LEFT JOIN lookup ON upper(state) = name
    """,
    "silver_tests": f"""
        SELECT full_date, code AS state_code, state_name, tests_total_cum, tests_pos_cum,
               tests_neg_cum, {_parts("full_date")}
        FROM (
            SELECT cast(strptime(date, '%Y%m%d') AS date) AS full_date,
                   upper(trim(state)) AS code,
                   cast(totalTestResults AS bigint) AS tests_total_cum,
                   cast(positive AS bigint) AS tests_pos_cum,
                   cast(negative AS bigint) AS tests_neg_cum
            FROM tests
        ) LEFT JOIN clean_lookup ON code = state_code
    """,
    "silver_tests_text": f"""
        SELECT date AS date_id, state AS state_code,
               cast(totalTestResults AS bigint) AS tests_total,
               cast(positive AS bigint) AS tests_positive,
               cast(negative AS bigint) AS tests_negative, {_text_parts("date")}
        FROM tests
    """,
    "silver_feed": """
        SELECT date, state, cast(cases AS bigint) AS cases, cast(deaths AS bigint) AS deaths,
               cast(new_cases AS bigint) AS new_cases,
               cast(nullif(new_deaths, 'n/a') AS bigint) AS new_deaths
        FROM feed
    """,
    "fact_cases": f"""
        SELECT {_date_id("full_date")} AS date_id, state_code, cases_cum, deaths_cum,
               {_delta("cases_cum", True)} AS new_cases,
               {_delta("deaths_cum", True)} AS new_deaths
        FROM silver_cases
    """,
    "fact_tests": f"""
        SELECT {_date_id("full_date")} AS date_id, state_code, tests_total_cum, tests_pos_cum,
               tests_neg_cum, {_delta("tests_total_cum", True)} AS new_tests,
               {_RATE} AS positivity_rate
        FROM silver_tests
    """,
    "fact_feed": """
        SELECT date, name AS state_name, cases, deaths, new_cases, new_deaths
        FROM silver_feed LEFT JOIN lookup ON trim(state) = trim(abbr)
    """,
    "cases_dirty": """
        SELECT CASE m WHEN 3 THEN replace(date, '-', '/') WHEN 9 THEN NULL ELSE date END AS date,
               CASE m WHEN 5 THEN upper(state) WHEN 12 THEN state || ' ' WHEN 20 THEN NULL ELSE state END
                   AS state,
               CASE WHEN m % 6 = 1 THEN cases || '.7' WHEN m % 6 = 2 THEN 'n/a'
                    WHEN m % 6 = 3 THEN ' ' || cases || ' ' WHEN m = 28 THEN '' ELSE cases END AS cases,
               CASE WHEN m % 4 = 0 THEN NULL WHEN m % 7 = 5 THEN '-' || deaths
                    WHEN m % 10 = 6 THEN deaths || 'x' ELSE deaths END AS deaths
        FROM (SELECT *, day(cast(date AS date)) AS m FROM cases)
    """,
    "tests_dirty": """
        SELECT CASE m WHEN 4 THEN concat_ws('-', substr(date, 1, 4), substr(date, 5, 2), substr(date, 7, 2))
                      WHEN 8 THEN substr(date, 1, 4) || '13' || substr(date, 7, 2)
                      WHEN 15 THEN NULL ELSE date END AS date,
               CASE m WHEN 6 THEN state || '  ' WHEN 22 THEN NULL ELSE state END AS state,
               CASE m WHEN 10 THEN '0' WHEN 17 THEN 'n/a' WHEN 2 THEN totalTestResults || '.0'
                      ELSE totalTestResults END AS totalTestResults,
               CASE m WHEN 12 THEN NULL WHEN 18 THEN '' ELSE positive END AS positive,
               CASE m WHEN 25 THEN '~' || negative ELSE negative END AS negative
        FROM (SELECT *, cast(substr(date, 7, 2) AS integer) AS m FROM tests)
    """,
    "typed_cases_dirty": f"""
        SELECT cases_dirty.*, CASE WHEN date NOT LIKE '%/%' THEN cast(date AS date) END AS full_date,
               state_code, state_name, {_lenient("cases")} AS cases_cum, {_lenient("deaths")} AS deaths_cum
        FROM cases_dirty LEFT JOIN clean_lookup ON {_initcap("state")} = state_name
    """,
    "silver_cases_dirty": f"""
        SELECT full_date, state_code, state_name, cases_cum, deaths_cum, {_parts("full_date")}
        FROM typed_cases_dirty WHERE full_date IS NOT NULL AND state_code IS NOT NULL
    """,
    "typed_tests_dirty": f"""
        SELECT t.*, state_name FROM (
            SELECT *, cast(try_strptime(CASE WHEN regexp_full_match(date, '[0-9]{{8}}') THEN date END, '%Y%m%d') AS date)
                       AS full_date,
                   upper(trim(state)) AS state_code,
                   {_lenient("totalTestResults")} AS tests_total_cum,
                   {_lenient("positive")} AS tests_pos_cum, {_lenient("negative")} AS tests_neg_cum
            FROM tests_dirty
        ) AS t LEFT JOIN clean_lookup ON t.state_code = clean_lookup.state_code
    """,
    "silver_tests_dirty": f"""
        SELECT full_date, state_code, state_name, tests_total_cum, tests_pos_cum, tests_neg_cum,
               {_parts("full_date")}
        FROM typed_tests_dirty WHERE full_date IS NOT NULL AND state_code IS NOT NULL
    """,
    "fact_tests_dirty": f"""
        SELECT {_date_id("full_date")} AS date_id, state_code, tests_total_cum, tests_pos_cum,
               tests_neg_cum, {_delta("tests_total_cum", True)} AS new_tests,
               {_RATE} AS positivity_rate
        FROM silver_tests_dirty
    """,
    "faults_cases": f"""
        SELECT date, state, cases, deaths, full_date IS NULL OR state_code IS NULL AS lost,
               concat_ws(',', CASE WHEN full_date IS NULL THEN 'full_date' END,
                         CASE WHEN state_code IS NULL THEN 'state_code' END,
                         {", ".join(_unreadable(["cases", "deaths"]))}) AS faults
        FROM typed_cases_dirty
    """,
    "faults_tests": f"""
        SELECT date, state, totalTestResults, positive, negative,
               concat_ws(',', CASE WHEN full_date IS NULL THEN 'full_date' END,
                         CASE WHEN state_code IS NULL THEN 'state_code' END,
                         {", ".join(_unreadable(["totalTestResults", "positive", "negative"]))}) AS faults
        FROM typed_tests_dirty
    """,
    "all_dates": """
        SELECT full_date FROM silver_cases UNION SELECT full_date FROM silver_tests
    """,
    "dim_date": f"""
        SELECT {_date_id("full_date")} AS date_id, full_date, {_parts("full_date")},
               cast(isodow(full_date) AS integer) AS dow, isodow(full_date) >= 6 AS is_weekend
        FROM all_dates
    """,
    "deltas": f"SELECT *, {_LEVEL_DELTA} AS delta FROM level",
    "first_cases": """
        SELECT * FROM fact_cases
        QUALIFY row_number() OVER (PARTITION BY state_code ORDER BY date_id) <= 500
    """,
    "first_tests": """
        SELECT * FROM fact_tests
        QUALIFY row_number() OVER (PARTITION BY state_code ORDER BY date_id) <= 500
    """,
    "numbers_as_text": """
        SELECT l_orderkey, l_linenumber, CASE
            WHEN l_returnflag = 'A' THEN concat('-', l_orderkey, '.', l_linenumber)
            WHEN l_returnflag = 'R' THEN concat('x', l_orderkey)
            WHEN l_linestatus = 'O' THEN concat(' ', l_orderkey, ' ')
            ELSE cast(l_orderkey AS varchar) END AS text
        FROM lineitem
    """,
    "dates_as_text": """
        SELECT o_orderkey, CASE WHEN o_orderstatus = 'P'
            THEN replace(cast(cast(o_orderdate AS date) AS varchar), '-', '/')
            ELSE cast(cast(o_orderdate AS date) AS varchar) END AS text
        FROM orders
    """,
}

_SINK_DENSE = "SELECT * FROM dense"

_SELECTS = {
    "scan_csv": "SELECT * FROM cases",
    "scan_csv_with_schema": "SELECT * FROM tests",
    "table_csv_positional": "SELECT * FROM feed",
    "scan_parquet": "SELECT * FROM silver_cases",
    "scan_table_all": "SELECT * FROM dim_date",
    "region_lookup": "SELECT * FROM clean_lookup",
    "table_parquet_repaired": _SINK_DENSE,
    "sink_parquet": "SELECT * FROM dim_date",
    "sink_partitioned_by_day": _SINK_DENSE,
    "sink_partitioned_by_date": _SINK_DENSE,
    "sink_partitioned_by_region": "SELECT * FROM fact_cases",
    "sink_sorted": "SELECT * FROM dim_date",
    "sink_csv": "SELECT COLUMNS(*)::varchar FROM fact_cases",
    "table_replaced": "SELECT * FROM silver_feed",
    "publish_dim_date": """
        SELECT date_id, full_date, year::smallint AS year, month::smallint AS month,
               day::smallint AS day, dow::smallint AS dow, is_weekend
        FROM dim_date
    """,
    "publish_dim_state": "SELECT DISTINCT state_code, state_name FROM silver_cases",
    "publish_fact_cases": """
        SELECT date_id, state_code, cases_cum, deaths_cum, new_cases::integer AS new_cases,
               new_deaths::integer AS new_deaths
        FROM fact_cases
    """,
    "publish_fact_testing": """
        SELECT date_id, state_code, tests_total_cum, tests_pos_cum, tests_neg_cum,
               new_tests::integer AS new_tests, positivity_rate
        FROM fact_tests
    """,
    "publish_layout": "SELECT * FROM fact_tests",
    "project_fact": "SELECT state_code, date_id, new_cases, new_deaths FROM fact_cases",
    "rename_keys": """
        SELECT date, state AS state_code, totalTestResults, positive, negative FROM tests
    """,
    "cast_lenient_long": r"""
        SELECT *, CASE WHEN regexp_full_match(trim(text), '[+-]?[0-9]+([.][0-9]*)?')
            THEN cast(regexp_extract(trim(text), '^[+-]?[0-9]+') AS bigint) END AS value
        FROM numbers_as_text
    """,
    "try_cast_long": """
        SELECT *, CASE WHEN regexp_full_match(trim(text), '[+-]?[0-9]+')
            THEN cast(trim(text) AS bigint) END AS value
        FROM numbers_as_text
    """,
    "date_key_text": "SELECT date, state, replace(date, '-', '') AS date_id FROM cases",
    "date_parts_text": f"SELECT date, state, {_text_parts('date', 'varchar')} FROM tests",
    "normalise_code": "SELECT date, state, upper(trim(state)) AS code FROM tests",
    "normalise_name": f"""
        SELECT p_partkey, string_agg({_initcap("word")}, ' ' ORDER BY place) AS name
        FROM (
            SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word,
                   generate_subscripts(string_split(p_name, ' '), 1) AS place
            FROM part
        ) GROUP BY p_partkey
    """,
    "parse_iso_date": """
        SELECT *, CASE WHEN text NOT LIKE '%/%' THEN cast(text AS date) END AS date
        FROM dates_as_text
    """,
    "parse_compact_date": """
        SELECT state, date, cast(strptime(date, '%Y%m%d') AS date) AS full_date FROM tests
    """,
    "date_parts": f"""
        SELECT o_orderkey, cast(o_orderdate AS date) AS full_date, {_parts("o_orderdate")}
        FROM orders
    """,
    "date_key_int": f"SELECT o_orderkey, {_date_id('o_orderdate')} AS date_id FROM orders",
    "date_label": f"SELECT state_code, date_id, {_LABEL} AS date FROM fact_cases",
    "positivity_percent": f"""
        SELECT full_date, state_code, CASE WHEN tests_total_cum > 0
            THEN {_round2("tests_pos_cum / tests_total_cum * 100")} END AS positivity_rate
        FROM silver_tests
    """,
    "filter_region": f"SELECT * FROM fact_cases WHERE state_code = '{REGION}'",
    "filter_date": f"SELECT * FROM fact_cases WHERE date_id = {DATE_ID}",
    "filter_regions": f"SELECT * FROM fact_cases WHERE state_code IN ({_REGIONS})",
    "resolve_region_names": f"""
        SELECT fact_cases.*, state_name FROM fact_cases JOIN clean_lookup USING (state_code)
        WHERE state_name IN ({_NAMES})
    """,
    "require_keys": "SELECT * FROM silver_cases",
    "fill_null_zero": f"SELECT *, coalesce(lag(value) {_BY_USER}, 0) AS previous FROM level",
    "left_join_name": f"""
        SELECT cases.*, state_code, state_name
        FROM cases LEFT JOIN clean_lookup ON {_initcap("state")} = state_name
    """,
    "left_join_exact": """
        SELECT date, upper(state) AS state, cases, deaths, abbr AS state_code, name AS state_name
        FROM cases LEFT JOIN lookup ON upper(state) = name
    """,
    "left_join_code": """
        SELECT tests.*, upper(trim(state)) AS state_code, state_name
        FROM tests LEFT JOIN clean_lookup ON upper(trim(state)) = state_code
    """,
    "left_join_trim": """
        SELECT feed.*, name AS state_name FROM feed LEFT JOIN lookup ON trim(state) = trim(abbr)
    """,
    "join_fact_dim": """
        SELECT fact_tests.*, state_name FROM fact_tests JOIN clean_lookup USING (state_code)
    """,
    "join_fact_date": """
        SELECT date_id, state_code, new_tests, full_date, year, month, day, dow, is_weekend
        FROM fact_tests JOIN dim_date USING (date_id)
    """,
    "join_fact_fact": "SELECT * FROM fact_cases JOIN fact_tests USING (date_id, state_code)",
    "orphan_dates": f"""
        SELECT * FROM fact_tests
        WHERE date_id NOT IN (SELECT {_date_id("full_date")} FROM silver_cases)
    """,
    "distinct_multi": "SELECT DISTINCT date_id, year, month, day FROM silver_cases_text",
    "distinct_single": "SELECT DISTINCT state_code FROM silver_cases_text",
    "dim_region": "SELECT DISTINCT state_code, state_name FROM silver_cases",
    "qa_date_range": """
        SELECT min(full_date) AS min_date, max(full_date) AS max_date, count(*) AS "rows"
        FROM silver_cases
    """,
    "qa_count_by_region": """
        SELECT state_code, count(*) AS "rows" FROM silver_tests GROUP BY 1 ORDER BY 2 DESC, 1
    """,
    "daily_total_new_cases": """
        SELECT date, cast(coalesce(sum(new_cases), 0) AS bigint) AS new_cases
        FROM fact_feed WHERE date IS NOT NULL GROUP BY 1 ORDER BY 1
    """,
    "top_regions_total": """
        SELECT state_name, arg_max(cases, cast(date AS date)) AS cases
        FROM fact_feed WHERE state_name IS NOT NULL AND cases IS NOT NULL
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10
    """,
    "top_regions_total_cumulative": """
        SELECT state_name, cast(coalesce(sum(cases), 0) AS bigint) AS cases
        FROM fact_feed WHERE state_name IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10
    """,
    "duplicate_keys": """
        SELECT user_id, event_type, count(*) AS "count" FROM events
        GROUP BY 1, 2 HAVING count(*) > 1
    """,
    "union_dates": "SELECT * FROM all_dates",
    "lag_previous": f"SELECT *, lag(value) {_BY_USER} AS previous FROM level",
    "daily_delta_clamped": f"""
        SELECT *, greatest(value - lag(value) {_BY_USER}, 0) AS delta FROM level
    """,
    "daily_delta_signed": "SELECT * FROM deltas",
    "daily_delta_cut_series": "SELECT * FROM deltas",
    "moving_avg_cut_series": f"SELECT *, {_average('new_cases')} FROM fact_cases",
    "moving_avg_cases": f"SELECT *, {_average('new_cases')} FROM fact_cases",
    "moving_avg_positivity": f"SELECT *, {_average('positivity_rate')} FROM fact_tests",
    "first_n_per_region": "SELECT * FROM first_cases",
    "silver_cases": "SELECT * FROM silver_cases",
    "silver_cases_text_key": "SELECT * FROM silver_cases_text",
    "silver_tests": "SELECT * FROM silver_tests",
    "silver_tests_text_key": "SELECT * FROM silver_tests_text",
    "silver_typed_copy": "SELECT * FROM silver_feed",
    "dim_date": "SELECT * FROM dim_date",
    "dim_date_simple": "SELECT DISTINCT date_id, year, month, day FROM silver_cases_text",
    "region_codes": "SELECT DISTINCT state_code FROM silver_cases_text",
    "fact_cases": "SELECT * FROM fact_cases",
    "fact_cases_signed": f"""
        SELECT date_id, state_code, cases, deaths,
               {_delta("cases", False, "date_id", "state_code, state_name")} AS new_cases,
               {_delta("deaths", False, "date_id", "state_code, state_name")} AS new_deaths
        FROM silver_cases_named
    """,
    "fact_testing": "SELECT * FROM fact_tests",
    "fact_testing_percent": f"""
        SELECT date_id, state_code, tests_total, tests_positive, tests_negative,
               {_delta("tests_total", False, "date_id")} AS new_tests,
               CASE WHEN tests_total > 0
                   THEN {_round2("tests_positive / tests_total * 100")} END AS positivity_rate
        FROM silver_tests_text
    """,
    "fact_denormalised": "SELECT * FROM fact_feed",
    "sorted_lookup": "SELECT * FROM clean_lookup ORDER BY state_name, state_code",
    "cases_trend": f"""
        SELECT {_LABEL} AS date, state_code, state_name, new_cases, new_deaths,
               {_average("new_cases")}, {_average("new_deaths")}
        FROM fact_cases JOIN clean_lookup USING (state_code)
    """,
    "cases_trend_unlimited": f"""
        SELECT {_LABEL} AS date, state_code, state_name, new_cases, new_deaths,
               {_average("new_cases")}, {_average("new_deaths")}
        FROM fact_cases JOIN clean_lookup USING (state_code)
    """,
    "testing_trend": f"""
        SELECT {_LABEL} AS date, state_code, state_name, new_tests, positivity_rate,
               {_average("new_tests")}, {_average("positivity_rate")}
        FROM fact_tests JOIN clean_lookup USING (state_code) WHERE state_name IN ({_NAMES})
    """,
    "combined_cases": f"""
        SELECT {_LABEL} AS date, state_code, state_name, new_cases, new_deaths,
               {_average("new_cases")}
        FROM fact_cases JOIN clean_lookup USING (state_code)
        WHERE state_name IN ({_NAMES}) AND state_code IN (SELECT state_code FROM fact_tests)
    """,
    "combined_tests": f"""
        SELECT {_LABEL} AS date, state_code, state_name, new_tests, positivity_rate,
               {_average("new_tests")}, {_average("positivity_rate")}
        FROM fact_tests JOIN clean_lookup USING (state_code)
        WHERE state_code IN (SELECT state_code FROM fact_cases)
    """,
    "cases_trend_limited": f"""
        SELECT {_LABEL} AS date, state_code, state_name, new_cases, new_deaths,
               {_average("new_cases")}, {_average("new_deaths")}
        FROM first_cases JOIN clean_lookup USING (state_code)
    """,
    "testing_trend_limited": f"""
        SELECT {_LABEL} AS date, state_code, state_name, new_tests, positivity_rate,
               {_average("new_tests")}, {_average("positivity_rate")}
        FROM first_tests JOIN clean_lookup USING (state_code) WHERE state_name IN ({_NAMES})
    """,
    "cases_trend_shared_code": f"""
        SELECT {_LABEL} AS date, state_code, state_name || suffix AS state_name, new_cases, new_deaths,
               {_average("new_cases", "state_code, suffix")}, {_average("new_deaths", "state_code, suffix")}
        FROM fact_cases JOIN clean_lookup USING (state_code), (VALUES (''), (' State')) AS s(suffix)
    """,
    "top_new_cases_on_date": f"""
        SELECT state_code, state_name, new_cases
        FROM fact_cases JOIN clean_lookup USING (state_code) WHERE date_id = {DATE_ID}
        ORDER BY new_cases DESC NULLS LAST, state_code LIMIT 5
    """,
    "top_positivity_on_date": f"""
        SELECT state_code, state_name, positivity_rate
        FROM fact_tests JOIN clean_lookup USING (state_code) WHERE date_id = {DATE_ID}
        ORDER BY positivity_rate DESC NULLS LAST, state_code LIMIT 5
    """,
    "positivity_trend": f"""
        SELECT full_date, {_POSITIVITY}
        FROM fact_tests JOIN dim_date USING (date_id) WHERE state_code = '{REGION}'
        ORDER BY full_date
    """,
    "cases_vs_tests": f"""
        SELECT state_code, full_date, new_cases, new_tests, {_POSITIVITY}
        FROM fact_cases JOIN fact_tests USING (date_id, state_code) JOIN dim_date USING (date_id)
        ORDER BY state_code, full_date
    """,
    "cases_vs_tests_by_key": f"""
        SELECT state_code, full_date, new_cases, new_tests, {_POSITIVITY}
        FROM fact_cases JOIN fact_tests USING (date_id, state_code) JOIN dim_date USING (date_id)
        ORDER BY state_code, full_date
    """,
    "cases_vs_tests_of_region": f"""
        SELECT full_date, new_cases, new_tests, {_POSITIVITY}
        FROM fact_cases JOIN fact_tests USING (date_id, state_code) JOIN dim_date USING (date_id)
        WHERE state_code = '{REGION}' ORDER BY full_date
    """,
    "preview_dim_date": "SELECT * FROM dim_date ORDER BY date_id LIMIT 10",
    "preview_ranges": "SELECT * FROM fact_cases ORDER BY date_id, state_code LIMIT 25",
    "null_violations": "SELECT * FROM silver_cases_kept WHERE state_code IS NULL",
    "too_long": "SELECT * FROM nation WHERE length(n_name) > 8",
    "negative_deltas": "SELECT * FROM deltas WHERE delta < 0",
    "unmatched_names": f"""
        SELECT state, count(*) AS "rows" FROM cases
        WHERE {_initcap("state")} NOT IN (SELECT state_name FROM clean_lookup) GROUP BY state
    """,
    "pipeline_star": "SELECT * FROM fact_tests",
    "pipeline_text_key": f"""
        SELECT date_id, state_code, cases, deaths,
               {_delta("cases", False, "date_id", "state_code, state_name")} AS new_cases,
               {_delta("deaths", False, "date_id", "state_code, state_name")} AS new_deaths
        FROM silver_cases_named
    """,
    "star_faults": """
        SELECT * FROM (WITH dim_state AS (SELECT DISTINCT state_code, state_name FROM silver_cases),
        tables AS (
            SELECT 'dim_date' AS name, date_id, NULL AS state_code FROM dim_date
            UNION ALL SELECT 'dim_state', NULL, state_code FROM dim_state
            UNION ALL SELECT 'fact_cases_state_daily', date_id, state_code FROM fact_cases
            UNION ALL SELECT 'fact_testing_state_daily', date_id, state_code FROM fact_tests
        )
        SELECT name || ': missing key' AS "check",
               count(CASE WHEN (name <> 'dim_state' AND date_id IS NULL)
                            OR (name <> 'dim_date' AND state_code IS NULL) THEN 1 END) AS "rows"
        FROM tables GROUP BY name
        UNION ALL
        SELECT name || ': repeated key', count(CASE WHEN n > 1 THEN 1 END)
        FROM (SELECT name, date_id, state_code, count(*) AS n FROM tables GROUP BY 1, 2, 3)
        GROUP BY name
        UNION ALL
        SELECT name || ': date not in dim_date',
               count(CASE WHEN date_id NOT IN (SELECT date_id FROM dim_date) THEN 1 END)
        FROM tables WHERE name LIKE 'fact%' GROUP BY name)
    """,
    "emptiness": """
        SELECT (SELECT count(*) FROM fact_cases) > 0 AND (SELECT count(*) FROM fact_tests) > 0
                   AS both_present,
               (SELECT count(*) FROM fact_cases WHERE state_code = 'no such region') = 0
                   AS none_is_empty
    """,
    "filter_date_text_key": f"SELECT * FROM silver_cases_text WHERE date_id = '{DATE_ID}'",
    "daily_delta_cut_dashed_text": """
        SELECT cast(full_date AS varchar) AS day, state_code AS state, n,
               coalesce(n - lag(n) OVER (PARTITION BY state_code ORDER BY full_date), 0) AS delta
        FROM dense
    """,
    "pipeline_published": """
        SELECT date_id, state_code, cases_cum, deaths_cum, new_cases::integer AS new_cases,
               new_deaths::integer AS new_deaths
        FROM fact_cases
    """,
    "pipeline_feed": "SELECT * FROM fact_feed",
    "pipeline_default": "SELECT * FROM fact_cases",
    "layout_by_day": """
        SELECT count(*) AS folders, count(*) AS files
        FROM (SELECT DISTINCT state_code, year, month, day FROM dense)
    """,
    "appended_partitions": "SELECT * FROM silver_cases",
    "appended_days": "SELECT * FROM fact_tests",
    "silver_cases_dirty": "SELECT * FROM silver_cases_dirty",
    "silver_tests_dirty": "SELECT * FROM silver_tests_dirty",
    "fact_cases_dirty": f"""
        SELECT {_date_id("full_date")} AS date_id, state_code, cases_cum, deaths_cum,
               {_delta("cases_cum", True)} AS new_cases, {_delta("deaths_cum", True)} AS new_deaths
        FROM silver_cases_dirty
    """,
    "fact_testing_dirty": "SELECT * FROM fact_tests_dirty",
    "moving_avg_dirty": f"SELECT *, {_average('positivity_rate')} FROM fact_tests_dirty",
    "parse_compact_date_malformed": "SELECT state, date, full_date FROM typed_tests_dirty",
    # An empty field of a CSV file has no value.
    "quarantined_cases": """
        SELECT date, state, nullif(cases, '') AS cases, deaths, faults FROM faults_cases WHERE lost
    """,
    "quarantined_tests_strict": """
        SELECT date, state, totalTestResults, nullif(positive, '') AS positive, negative, faults
        FROM faults_tests WHERE faults <> ''
    """,
    "quarantine_balance": """
        SELECT 'cases' AS feed, count(*) AS "read", count(CASE WHEN faults = '' THEN 1 END) AS kept,
               count(CASE WHEN faults <> '' THEN 1 END) AS quarantined FROM faults_cases
        UNION ALL
        SELECT 'tests', count(*), count(CASE WHEN faults = '' THEN 1 END),
               count(CASE WHEN faults <> '' THEN 1 END) FROM faults_tests
    """,
}

_WITH = "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in _TABLES.items())


def oracle_sql():
    return {name: f"{_WITH}\n{select}" for name, select in _SELECTS.items()}
