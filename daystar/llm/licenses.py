"""License scans: entire texts looked up by the digest of their canonical form.

Case, punctuation, copyright lines and equivalent spellings do not count. A document's
whole text and each of its lines are entire texts; both are joined to the known digests.
The digest that is given out drops every line that starts with a copyright mark. Licences are
also looked up without the holder statements only, so text after one on its line counts,
and so do wrapped lines of a licence that happen to start with "copyright".
Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from daystar.llm.license_digests import FULL
from daystar.llm.license_texts import KNOWN

# Spellings that mean the same, each with the form that stands for it.
SPELLINGS = (
    (r"sub-?licen[cs]e", "sublicense"),
    (r"licence", "license"),
    (r"non-?infringement", "noninfringement"),
    (r"organisation", "organization"),
    (r"https?://", "http "),
    (r"&", " and "),
)
# A line of copyright holders or reserved rights, with the line break before it.
COPYRIGHT_LINE = (
    r"(^|\n)[^\p{L}\p{N}\n]*(?:copyright|\(c\)|©|all rights reserved)[^\n]*"
)
# A statement of holders or reserved rights from the start of a line on: to its end, or to
# the words that licence texts start with.
_PROSE = (
    r"notices?|holders?|owners?|laws?|licen[cs]es?|statements?|interests?|rights?|treaty|act|disclaimers?"
    r"|protection|permissions?|infringement|also|and|or|in|to|is|on|of|as|for|that|which|may"
)
_STARTS = (
    r"permission (?:is hereby granted|to use)|(?:licensed|released|distributed) under|redistribution and use"
    r"|this (?:work|program|software|file|library|code|project) (?:is|are)|everyone is permitted|the mit license|mit license|isc license"
)
HOLDER = (
    r"(^|\n)[^\p{L}\p{N}\n]*(?:(?:copyright|©)(?![\"”]|able\b|ed\b|\s*(?:" + _PROSE + r")\b)|\(c\)\s*(?:copyright|\d)"
    r"|all rights reserved)[^\n]*?(?=\n|$|\b(?:" + _STARTS + r"))"
)
_MARK = r"copyright|\(c\)|©|all rights reserved"
MARKS = r"[^\p{L}\p{N}\n]+"


def canonical(text, statement=COPYRIGHT_LINE):
    """Canonical form with its line breaks, without what `statement` finds; a null text is empty."""
    column = F.lower(F.coalesce(text, F.lit("")))
    column = F.regexp_replace(column, statement, "$1")
    for pattern, standard in SPELLINGS:
        column = F.regexp_replace(column, pattern, standard)
    return F.regexp_replace(column, MARKS, " ")


def _one_line(column):
    return F.trim(F.regexp_replace(column, r"[ \n]+", " "))


def _digest(column):
    return F.sha2(column.cast("binary"), 256)


def known_digests(spark, known=KNOWN, full=FULL):
    """license and digest of the known texts, in both forms, and of the licences in `full`.

    Of several licences of one digest the least.
    """
    rows = spark.createDataFrame(list(known), "license string, text string")
    forms = [
        _digest(_one_line(canonical(F.col("text"), statement))) for statement in (COPYRIGHT_LINE, HOLDER)
    ]
    rows = rows.select("license", F.explode(F.array(*forms)).alias("digest"))
    if full:
        rows = rows.union(spark.createDataFrame(list(full), "license string, digest string"))
    return rows.groupBy("digest").agg(F.min("license").alias("license"))


def scan(docs, known):
    """doc_id, digest, license, n_notices and notices per row of `docs`.

    `license` is the licence that the whole text is, or null; The
    whole text and its lines are looked up without holder statements too. `notices` are the different
    licences that its lines are, sorted and comma-joined, `n_notices` the number of such
    lines. Empty and null texts have the digest of an empty text and match nothing unless
    the known texts hold one. Repeated rows are scanned each; an empty table gives no rows.
    Only digests reach the joins, so no text is shuffled, and a digest that very many
    documents have is one row of the known side.
    """
    canon = docs.select("doc_id", "text", canonical(F.col("text")).alias("canon")).select(
        "doc_id",
        "canon",
        F.when(F.lower("text").rlike(_MARK), canonical(F.col("text"), HOLDER))
        .otherwise(F.col("canon"))
        .alias("legal"),
    )
    lines = F.filter(
        F.transform(F.split("legal", "\n"), lambda line: F.trim(line)), lambda line: line != ""
    )
    digests = canon.select(
        "doc_id",
        F.monotonically_increasing_id().alias("row"),
        _digest(_one_line(F.col("canon"))).alias("digest"),
        _digest(_one_line(F.col("legal"))).alias("legal"),
        F.transform(lines, lambda line: F.sha2(line.cast("binary"), 256)).alias("lines"),
    )
    # Both kinds of entire texts go through one join: the whole text is entry 0
    # and, without holder statements only, entry 1.
    entries = digests.select(
        "doc_id",
        "row",
        "digest",
        F.posexplode(F.concat(F.array("digest", "legal"), "lines")).alias("entry", "of"),
    )
    matched = entries.join(known.withColumnRenamed("digest", "of"), "of", "left")
    notice = (F.col("entry") > 1) & F.col("license").isNotNull()
    return (
        matched.groupBy("row", "doc_id", "digest")
        .agg(
            F.coalesce(
                *(F.max(F.when(F.col("entry") == place, F.col("license"))) for place in (0, 1))
            ).alias("license"),
            F.count(F.when(notice, 1)).alias("n_notices"),
            F.array_join(
                F.array_sort(F.collect_set(F.when(notice, F.col("license")))), ","
            ).alias("notices"),
        )
        .drop("row")
    )
