"""Periodic runs of words: stretches that repeat with a period, found in suffix trees.

Every run holds a Lyndon word of its period, and that word is the longest Lyndon word at its
start in one of the two orders of the words (the runs theorem). So each position and order
gives one candidate, from its next smaller suffix; common extensions to both sides, of the
tree of the words and of the tree of their reversal, tell how far its period reaches.
"""

from __future__ import annotations

from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from daystar.llm.suffix_tree import SuffixTree
from daystar.llm.tables import WORD, text_or_empty

#: A run has at least this many words, and at least two periods.
LEAST = 12
#: Rows that go back to Spark at once.
SLICE_ROWS = 256
#: How often a stretch is looked through again before trees are built of it.
ROUNDS = 8
#: Odd, so that products of hashes spread over 64 bits.
MIX = np.uint64(0x9E3779B97F4A7C15)


def next_smaller(ranks):
    """Of every suffix but the empty one, the next position with a smaller suffix.

    The last rank is that of the empty suffix, which is smaller than all others.
    """
    following, waiting = [0] * (len(ranks) - 1), []
    for at, rank in enumerate(ranks.tolist()):
        while waiting and waiting[-1][1] > rank:
            following[waiting.pop()[0]] = at
        waiting.append((at, rank))
    return np.array(following)


def runs_of_numbers(words, alphabet, least=LEAST):
    """(start, length, period) of all runs of a sequence of numbers from 1 below `alphabet`."""
    size = len(words)
    if size < max(least, 2):
        return []
    forward = SuffixTree(words, alphabet)
    backward = SuffixTree(words[::-1], alphabet)
    at = np.arange(size)
    found = set()
    for descending in (False, True):
        following = next_smaller(forward.ranks(descending))
        period = following - at
        right = forward.common(at, following)
        # The words before a position are the start of the reversal from size - position on.
        left = backward.common(size - at, size - following)
        length = left + period + right
        good = np.flatnonzero((length >= least) & (length >= 2 * period))
        found.update(zip((at - left)[good].tolist(), length[good].tolist(), period[good].tolist(), strict=True))
    return sorted(found, key=lambda run: (run[0], run[2]))


def _repeated_stretches(keys, width):
    """Maximal stretches (start, end) of positions that windows with a repeated key cover.

    `keys` has one entry per position where a window of `width` words starts; windows that
    must not be matched with each other have different keys.
    """
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    same = ordered[1:] == ordered[:-1]
    repeated = np.zeros(len(keys), dtype=bool)
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    starts = np.flatnonzero(repeated)
    if not len(starts):
        return []
    gap = np.flatnonzero(np.diff(starts) > width)
    return list(
        zip(starts[np.append(0, gap + 1)].tolist(), (starts[np.append(gap, -1)] + width).tolist(), strict=True)
    )


def stretches(hashes, least=LEAST):
    """Stretches of a text, given as hashes of its words, outside which no run can lie.

    A run of `least` words and two periods q has a word, and then at least least / 2 words in a
    row, equal to those q further on. So windows of that width that occur twice cover all its words,
    and a longer run's too. Equal hashes of different words only add stretches. Stretches are
    looked through again by themselves, until their windows are repeated within them or ROUNDS are over.
    """
    width = (least + 1) // 2
    todo, done = [(0, len(hashes), 0)], []
    while todo:
        start, end, turn = todo.pop()
        if end - start < least:
            continue
        if turn == ROUNDS:
            done.append((start, end))
            continue
        part = hashes[start:end]
        keys = part[: len(part) - width + 1].copy()
        for step in range(1, width):
            keys = keys * MIX + part[step : len(part) - width + 1 + step]
        inner = _repeated_stretches(keys, width)
        if inner == [(0, end - start)]:
            done.append((start, end))
        else:
            todo += [(start + low, start + high, turn + 1) for low, high in inner]
    return sorted(done)


def runs_of_words(words, least=LEAST):
    """(start, length, period) of all runs of a list of words, by start, then period."""
    if len(words) < least:
        return []
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    found = []
    for start, end in stretches(hashes, least):
        numbers, unused = {}, count(1)
        part = [numbers.get(word) or numbers.setdefault(word, next(unused)) for word in words[start:end]]
        found += [(start + at, *rest) for at, *rest in runs_of_numbers(part, len(numbers) + 1, least)]
    return found


def collapsed(words, runs):
    """The words that stay when every run is cut down to its first period."""
    if not runs:
        return words
    covers = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        covers[start + period] += 1
        covers[start + length] -= 1
    keep = np.cumsum(covers[:-1]) == 0
    return [words[at] for at in np.flatnonzero(keep).tolist()]


def detect(docs, least=LEAST):
    """doc_id, n_words, runs and kept per row of `docs` (doc_id, text).

    `runs` lists start (word number from 0), length and period of every maximal run with its
    smallest period, at least `least` words and two periods, by start, then period. `kept` is the
    text with one blank between words and without the words that a run repeats after its first
    period. A null or empty text has no words. Rows keep their number: repeated rows, and rows
    without a doc_id, are looked at each, and other columns are not read.

    One pass without a shuffle. A text lies in one task; trees are built only of stretches that
    can hold runs, and take some 1 KB per word of a stretch.
    """
    source = docs.select("doc_id", text_or_empty().alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    of_runs = pa.list_(
        pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    )

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                ids, texts = batch.slice(at, SLICE_ROWS).columns
                sizes, runs, kept = [], [], []
                for text in texts:
                    words = text.as_py().encode().split()
                    own = runs_of_words(words, least)
                    sizes.append(len(words))
                    runs.append([{"start": s, "length": n, "period": p} for s, n, p in own])
                    kept.append(b" ".join(collapsed(words, own)).decode())
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(sizes, pa.int64()), pa.array(runs, of_runs), pa.array(kept, pa.string())],
                    names=["doc_id", "n_words", "runs", "kept"],
                )

    return source.mapInArrow(
        run,
        f"doc_id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, kept string",
    )


def looped(docs):
    """`docs` with a tenth of the texts made periodic from some word on, as op12 asks.

    With h = crc32 of doc_id's digits and g = floor(h / 10), texts with h % 10 = 0 and n > 0 words
    repeat p = 1 + floor((n - a) / (3 + g % 8)) words from word a = g % n on. Rows without a
    doc_id stay as they are.
    """
    words = F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(0))
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    of_words = docs.select(
        "doc_id",
        "text",
        F.floor(h / 10).alias("g"),
        F.when(h % 10 == 0, words).alias("words"),
    ).withColumn("n", F.size("words"))
    measured = of_words.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int")).withColumn(
        "p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int")
    )
    rest = F.col("n") - F.col("a")
    turns = F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.ceil(rest / F.col("p")).cast("int"))
    looped_words = F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(F.flatten(turns), F.lit(1), rest))
    return measured.select(
        "doc_id",
        F.when(F.coalesce(F.col("n") > 0, F.lit(False)), F.array_join(looped_words, " "))
        .otherwise(F.col("text"))
        .alias("text"),
    )


def report(detected):
    """doc_id, n_runs, the longest run, and digests of the runs and of the kept text.

    The longest run is that of greatest length, then smallest start, then smallest period; without runs its
    columns are null and the digest of the runs is that of an empty text.
    """
    longest = F.array_max(
        F.transform("runs", lambda run: F.struct(run.length.alias("n"), (-run.start).alias("s"), (-run.period).alias("p")))
    )
    lines = F.transform(
        "runs", lambda run: F.concat_ws(",", run.start.cast("string"), run.length.cast("string"), run.period.cast("string"))
    )
    return detected.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "runs", "kept", longest.alias("longest")).select(
        "doc_id",
        "n_runs",
        (-F.col("longest.s")).alias("start"),
        F.col("longest.n").alias("length"),
        (-F.col("longest.p")).alias("period"),
        F.floor(1000 * F.col("longest.n") / -F.col("longest.p")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("kept", 256).alias("collapsed_sha256"),
    )
