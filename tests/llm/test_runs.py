"""Periodic runs against a search of every period, and the query against its contract."""

from __future__ import annotations

import hashlib
import os
import random
import re
import zlib

import numpy as np
import pytest

from daystar.llm import runs
from daystar.llm.queries import QUERIES
from daystar.llm.suffix_tree import SuffixTree

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def every_period(words, least):
    """Runs by comparing the words with themselves at every distance."""
    numbers = {word: i for i, word in enumerate(dict.fromkeys(words))}
    at = np.array([numbers[word] for word in words])
    found = {}
    for period in range(1, len(words) // 2 + 1):
        same = np.concatenate([[False], at[period:] == at[:-period], [False]])
        turns = np.flatnonzero(np.diff(same.astype(int)))
        for start, end in zip(turns[::2].tolist(), turns[1::2].tolist(), strict=True):
            length = end - start + period
            # A longer period of the same stretch is no smallest one.
            if length >= max(least, 2 * period):
                found.setdefault((start, length), period)
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda run: (run[0], run[2]))


def contract(doc_id, text):
    """The columns of op12 by its wording."""
    words = WORD.findall(text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = every_period(words, 12)
    gone = {i for s, length, p in found for i in range(s + p, s + length)}
    longest = min(found, key=lambda run: (-run[1], run[0], run[2]), default=(None, None, None))
    return (
        len(found),
        *longest,
        1000 * longest[1] // longest[2] if found else None,
        sha("".join(f"{s},{length},{p}\n" for s, length, p in found)),
        sha(" ".join(word for i, word in enumerate(words) if i not in gone)),
    )


def test_runs_of_random_words():
    draw = random.Random(1)
    for _ in range(1500):
        words = [draw.choice("abcdef"[: draw.choice([1, 2, 2, 3, 6])]) for _ in range(draw.randint(0, 60))]
        if words and draw.random() < 0.5:
            a, p = draw.randrange(len(words)), draw.randint(1, 12)
            words = words[:a] + [words[a:][i % min(p, len(words) - a)] for i in range(len(words) - a)]
        least = draw.choice([2, 3, 5, 12])
        assert runs.runs_of_words(words, least) == every_period(words, least)


def test_extensions_and_ranks():
    draw = random.Random(2)
    for _ in range(200):
        words = [draw.randint(1, 3) for _ in range(draw.randint(1, 120))]
        tree, n = SuffixTree(words, 4), len(words)
        one, two = np.array([(draw.randint(0, n), draw.randint(0, n)) for _ in range(50)]).T
        wanted = []
        for a, b in zip(one, two, strict=True):
            k = 0
            while max(a, b) + k < n and words[a + k] == words[b + k]:
                k += 1
            wanted.append(k)
        assert tree.common(one, two).tolist() == wanted
        up = sorted(range(n + 1), key=lambda i: words[i:])
        down = sorted(range(n + 1), key=lambda i: [-w for w in words[i:]])
        assert np.argsort(tree.ranks()).tolist() == up
        assert np.argsort(tree.ranks(descending=True)).tolist() == down


def test_stretches_given_up_early_change_nothing(monkeypatch):
    draw = random.Random(3)
    words = [draw.choice("ab") for _ in range(400)] + ["x", "y", "z"] * 5
    wanted = runs.runs_of_words(words)
    monkeypatch.setattr(runs, "ROUNDS", 0)
    assert runs.runs_of_words(words) == wanted == every_period(words, 12)


def test_detect_awkward_rows(spark):
    loop = "a b c " * 5
    rows = [(1, loop, 9), (1, loop, 9), (None, loop + "end", 9), (2, None, 9), (3, "", 9), (4, "    x", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept int")
    found = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.kept) for r in runs.detect(df).collect()), key=str)
    assert found == sorted(
        [(1, 15, [(0, 15, 3)], "a b c")] * 2
        + [(None, 16, [(0, 15, 3)], "a b c end"), (2, 0, [], ""), (3, 0, [], ""), (4, 2, [], "   x")],
        key=str,
    )
    assert runs.detect(df.limit(0)).count() == 0


def test_very_long_texts(spark):
    """A long periodic text, and a long one of a single word."""
    words = [f"w{i % 30_000}" for i in range(70_000)]
    df = spark.createDataFrame([(1, " ".join(words)), (2, "x " * 100_000)], "doc_id long, text string")
    found = {r.doc_id: ([tuple(x) for x in r.runs], r.kept) for r in runs.detect(df).collect()}
    assert found == {1: ([(0, 70_000, 30_000)], " ".join(words[:30_000])), 2: ([(0, 100_000, 1)], "x")}


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_query(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    found = {r.doc_id: tuple(r)[1:] for r in QUERIES["op12_runs"](spark, SF_DIR).collect()}
    assert found == {r.doc_id: contract(r.doc_id, r.text) for r in docs}
    assert sum(row[0] > 0 for row in found.values()) >= len(docs) / 20


def test_looped_rows(spark):
    """Ids whose checksum ends in 0, with short texts; nulls and other rows stay."""
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows = [(i, " ".join(f"v{k}" for k in range(i % 40)), "x") for i in ids] + [(None, "a  b", "x"), (ids[0], None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, words string")
    found = runs.report(runs.detect(runs.looped(df))).collect()
    assert sorted((tuple(r) for r in found), key=str) == sorted(((i, *contract(i, t)) for i, t, _ in rows), key=str)
