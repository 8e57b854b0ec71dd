"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from daystar.llm.license_texts import KNOWN
from daystar.llm.licenses import COPYRIGHT_LINE, MARKS, SPELLINGS

# The same mix by sorting: running sums in the order of the points.
_MIX = r"""
WITH sizes AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS point
  FROM documents
), named AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) AS rank
  FROM sizes GROUP BY source
), weighed AS (
  SELECT *, CAST([3, 1, 2][(rank - 1) % 3 + 1] AS DOUBLE) AS weight,
         source_size * CAST(2 AS DOUBLE) AS cap,
         sum(source_size) OVER () * CAST(1.5 AS DOUBLE) AS budget
  FROM named
), remaining AS (
  SELECT *, budget - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         sum(weight) OVER (ORDER BY cap / weight, rank
                              ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS sharing,
         row_number() OVER (ORDER BY cap / weight, rank) AS place
  FROM weighed
), level AS (
  SELECT min(place) AS first_open, arg_min(rest, place) AS rest, arg_min(sharing, place) AS sharing
  FROM remaining WHERE weight * rest / sharing <= cap
), plan AS (
  SELECT source, source_size,
         CASE WHEN first_open IS NULL OR place < first_open THEN cap
              ELSE weight * level.rest / level.sharing END AS target
  FROM remaining, level
), budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM plan
), points AS (
  SELECT source, point, sum(size) AS n,
         sum(sum(size)) OVER (PARTITION BY source ORDER BY point) AS upto
  FROM sizes GROUP BY source, point
), crossing AS (
  SELECT p.source, arg_min(p.point, p.point) AS point, arg_min(p.upto, p.point) AS upto,
         arg_min(p.n, p.point) AS n, any_value(target - whole * source_size) AS rest
  FROM points p JOIN budgets b ON p.source IS NOT DISTINCT FROM b.source
  WHERE target - whole * source_size > 0 AND upto >= target - whole * source_size
  GROUP BY p.source
), bounds AS (
  SELECT b.source, source_size, target, whole,
         coalesce(CASE WHEN upto - rest < rest - (upto - n) THEN point + 1 ELSE point END, 0) AS bound
  FROM budgets b LEFT JOIN crossing c ON b.source IS NOT DISTINCT FROM c.source
)
SELECT doc_id, size, source_size, target,
       CAST(whole + CASE WHEN point < bound THEN 1 ELSE 0 END AS INTEGER) AS copies,
       CAST(size * (whole + CASE WHEN point < bound THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM sizes s JOIN bounds b ON s.source IS NOT DISTINCT FROM b.source
"""


def _canonical(column):
    """SQL of the canonical form; copyright lines, spellings and marks as in the operator."""
    sql = f"regexp_replace(lower(coalesce({column}, '')), '{COPYRIGHT_LINE}', '\\1', 'g')"
    for pattern, standard in SPELLINGS:
        sql = f"regexp_replace({sql}, '{pattern}', '{standard}', 'g')"
    return f"regexp_replace({sql}, '{MARKS}', ' ', 'g')"


def _one_line(sql):
    return f"trim(regexp_replace({sql}, '[ \\n]+', ' ', 'g'))"


def _licenses():
    known = ", ".join(
        "('{}', '{}')".format(name, text.replace("'", "''")) for name, text in KNOWN
    )
    return f"""
WITH known AS (
  SELECT sha256({_one_line(_canonical("text"))}) AS digest, min(license) AS license
  FROM (VALUES {known}) AS k(license, text) GROUP BY 1
), canon AS (
  SELECT doc_id, {_canonical("text")} AS canon, row_number() OVER () AS r FROM documents
), whole AS (
  SELECT doc_id, r, sha256({_one_line("canon")}) AS digest FROM canon
), lines AS (
  SELECT r, trim(unnest(string_split(canon, chr(10)))) AS line FROM canon
), notices AS (
  SELECT r, count(*) AS n, string_agg(DISTINCT license, ',' ORDER BY license) AS names
  FROM lines JOIN known ON sha256(line) = digest WHERE line <> '' GROUP BY r
)
SELECT doc_id, w.digest, license, coalesce(n, 0) AS n_notices, coalesce(names, '') AS notices
FROM whole w LEFT JOIN known k ON w.digest = k.digest LEFT JOIN notices USING (r)
"""


ORACLES = {"op1_mix": _MIX, "op3_licenses": _licenses()}
