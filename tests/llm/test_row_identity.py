"""Rows that share a doc_id, or have none, keep what is theirs alone."""

from __future__ import annotations

from collections import Counter

import pytest

from daystar.llm import lines, repeats

SHARED = [f"shared{i}" for i in range(30)]


@pytest.mark.parametrize("key", [None, 5, 2**63 - 1])
def test_lines_of_rows_with_one_id(spark, key):
    rows = [
        (1, "first words here\nalpha beta gamma"),
        (key, "own opening passage\nalpha beta gamma\nfrom the left row"),
        (key, "another start entirely\nnothing of it elsewhere\nfrom the right row"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = Counter(tuple(row) for row in lines.deduplicated(df).collect())
    assert kept == Counter([rows[0], (key, "own opening passage\nfrom the left row"), rows[2]])


@pytest.mark.parametrize("key", [None, 5])
def test_equal_rows_keep_one(spark, key):
    df = spark.createDataFrame([(key, "the only text")] * 4, "doc_id long, text string")
    assert Counter(r.text for r in lines.deduplicated(df).collect()) == {"the only text": 1, "": 3}
    copies = spark.createDataFrame([(key, " ".join(SHARED))] * 4, "doc_id long, text string")
    assert sorted(r.n_removed for r in repeats.deduplicated(copies).collect()) == [0, 30, 30, 30]


@pytest.mark.parametrize("key", [None, 5])
def test_repeats_of_rows_with_one_id(spark, key):
    left = [f"left{i}" for i in range(50)]
    right = [f"right{i}" for i in range(80)]
    rows = [
        (1, " ".join(SHARED)),
        (key, " ".join(left[:10] + SHARED + left[10:])),
        (key, " ".join(right)),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {(r.doc_id, r.kept) for r in repeats.deduplicated(df).collect()}
    assert kept == {rows[0], (key, " ".join(left)), rows[2]}


def test_repeats_between_rows_with_one_id(spark):
    """Of two rows without an id that share a passage one loses it."""
    rows = [(None, " ".join([f"{side}{i}" for i in range(25)] + SHARED)) for side in ("a", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.n_removed for r in repeats.deduplicated(df).collect()) == [0, 30]
