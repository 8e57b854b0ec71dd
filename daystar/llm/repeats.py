"""Substring dedup by fingerprints of fixed windows, in place of suffix trees.

In a suffix tree a node at word depth d stands for one sequence of d words, and the leaves
below it are the places where it starts; a passage of `window` words repeats where a node at
that depth has two leaves or more. No tree is built here: a fingerprint of the `window` words
names the node at that depth, and equal fingerprints are its leaves.

Prefixes have two fixed lengths. A short prefix that occurs once cannot
lead to a repeat, so only suffixes near short prefixes that occur twice are expanded to
full depth; of the short prefixes, those that are least in some window stand for all
(every window has one, and equal windows have the same). Full-depth prefixes split the
expanded suffixes into groups that are sorted and read one after the other, so no group
has to fit in memory. Adjacent repeated windows of a document join to maximal repeats.

A passage that a third of all documents share makes no large group: every batch of
documents settles its own repeats and hands on only its first occurrence.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Window
from pyspark.sql import functions as F

from daystar.llm.tables import LAST_ID, told_apart

SHORT = 6
WINDOW = 20
# Words that are hashed together before their rows leave the task.
_SLICE_WORDS = 1 << 20
# Odd multipliers of the two path fingerprints.
_STEPS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def words_of(text):
    """Words of a text: runs of anything but ASCII blanks, unchanged, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").split()


def _hashes(words):
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def _mix(values):
    """Spreads every bit of a fingerprint over all others."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        return values ^ (values >> np.uint64(29))


class _Powers:
    """Powers of an odd number and of its inverse, modulo 2^64, grown as needed."""

    def __init__(self, step):
        self.step, self.inverse = step, pow(step, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def first(self, n):
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            factors = np.full(size, self.step, dtype=np.uint64)
            inverses = np.full(size, self.inverse, dtype=np.uint64)
            factors[0] = inverses[0] = 1
            with np.errstate(over="ignore"):
                self.up, self.down = np.cumprod(factors), np.cumprod(inverses)
        return self.up[:n], self.down[:n]


_POWERS = [_Powers(step) for step in _STEPS]


def prefix_prints(hashes, length, which=0):
    """Fingerprint of the `length` words from every place on, by differences of sums."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    up, down = _POWERS[which].first(len(hashes))
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up, dtype=np.uint64)])
        return _mix((sums[length:] - sums[:n]) * down[:n])


def anchors(prints, span):
    """Places whose print is the least of some `span` neighbours; of equal ones the last."""
    if len(prints) < span:
        return np.zeros(0, dtype=np.int64)
    views = np.lib.stride_tricks.sliding_window_view(prints[::-1], span)
    least = np.arange(len(views)) + views.argmin(axis=1)
    return np.unique(len(prints) - 1 - least)


def _slices(batches, width):
    """Documents (id, tie, words, more columns) of Arrow batches in slices of bounded words."""
    held, size = [], 0
    for batch in batches:
        for row in zip(*batch.columns[:width], strict=True):
            values = [value.as_py() for value in row]
            words = words_of(values[2])
            held.append((values[0], values[1], words, *values[3:]))
            size += len(words)
            if size >= _SLICE_WORDS:
                yield held
                held, size = [], 0
    if held:
        yield held


def _first_of_each(*keys):
    """True for the first row of every distinct key, and the size of each row's group."""
    order = np.lexsort((np.arange(len(keys[0])), *keys))
    new = np.ones(len(order), dtype=bool)
    same = np.ones(max(len(order) - 1, 0), dtype=bool)
    for key in keys:
        same &= key[order][1:] == key[order][:-1]
    new[1:] = ~same
    group = np.cumsum(new) - 1
    first = np.zeros(len(order), dtype=bool)
    first[order] = new
    sizes = np.zeros(len(order), dtype=np.int64)
    sizes[order] = np.bincount(group)[group] if len(order) else 0
    return first, sizes


def _anchor_rows(docs, window, short):
    """(prefix, id, tie, start, known): anchors of every document.

    Of the anchors that a slice has several times all are known to repeat, and one of
    them stands for the slice; the others go with their document's.
    """

    def run(batches):
        for held in _slices(batches, 3):
            prefixes, ids, ties, starts = [], [], [], []
            for key, tie, words in held:
                if len(words) < window:
                    continue
                prints = prefix_prints(_hashes(words), short)
                found = anchors(prints, window - short + 1)
                prefixes.append(prints[found])
                ids.append(np.full(len(found), key, dtype=np.int64))
                ties.append(np.full(len(found), tie, dtype=np.int64))
                starts.append(found)
            if not ids:
                continue
            prefixes, ids, ties, starts = map(np.concatenate, (prefixes, ids, ties, starts))
            first, sizes = _first_of_each(prefixes)
            own = _mix(ids.astype(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.where(first, prefixes, own).view(np.int64)),
                    pa.array(ids),
                    pa.array(ties),
                    pa.array(starts.astype(np.int32)),
                    pa.array(sizes > 1),
                ],
                names=["prefix", "id", "tie", "start", "known"],
            )

    return docs.mapInArrow(run, "prefix long, id long, tie long, start int, known boolean")


def _suffix_rows(docs, window, short):
    """(node, check, id, tie, start): suffixes near repeated anchors, at full depth.

    `docs` has id, tie, text and the anchors' starts. In a slice the first suffix of a node,
    by id, tie and start, is handed on; the others are known not to be first, which a start of
    -1 - start says.
    """
    reach = window - short

    def run(batches):
        for held in _slices(batches, 4):
            nodes, checks, ids, ties, starts = [], [], [], [], []
            for key, tie, words, places in held:
                last = len(words) - window
                if last < 0:
                    continue
                near = np.unique(np.array(places)[:, None] - np.arange(reach + 1)[None, :])
                near = near[(near >= 0) & (near <= last)]
                hashes = _hashes(words)
                nodes.append(prefix_prints(hashes, window, 0)[near])
                checks.append(prefix_prints(_mix(hashes), window, 1)[near])
                ids.append(np.full(len(near), key, dtype=np.int64))
                ties.append(np.full(len(near), tie, dtype=np.int64))
                starts.append(near)
            if not ids:
                continue
            columns = [np.concatenate(column) for column in (nodes, checks, ids, ties, starts)]
            order = np.lexsort((columns[4], columns[3], columns[2]))
            nodes, checks, ids, ties, starts = (column[order] for column in columns)
            first, _ = _first_of_each(nodes, checks)
            known = ~first
            own = _mix(ids.astype(np.uint64))
            checks = (checks >> np.uint64(33)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.where(known, own, nodes).view(np.int64)),
                    pa.array(np.where(known, starts, checks).astype(np.int32)),
                    pa.array(ids),
                    pa.array(ties),
                    pa.array(np.where(known, -1 - starts, starts).astype(np.int32)),
                ],
                names=["node", "check", "id", "tie", "start"],
            )

    return docs.mapInArrow(run, "node long, check int, id long, tie long, start int")


def _gathered(rows):
    return rows.groupBy("id", "tie").agg(F.collect_list("start").alias("starts"))


def _keyed(docs):
    """id, tie and text: a null id counts as the greatest, a null text as empty.

    Both joins read these columns, so texts are shuffled once.
    """
    return told_apart(docs).select(
        F.col("key").alias("id"), "tie", F.coalesce("row.text", F.lit("")).alias("text")
    )


def _copies(keyed):
    """id and tie of the rows whose whole text an earlier row has, and copy, which is true."""
    prints = keyed.select(
        "id", "tie", F.xxhash64("text").alias("print"), F.xxhash64(F.lit(1), "text").alias("check")
    )
    first = prints.groupBy("print", "check").agg(F.min(F.struct("id", "tie")).alias("first"))
    later = prints.join(first, ["print", "check"]).where(F.struct("id", "tie") > F.col("first"))
    return later.select("id", "tie", F.lit(True).alias("copy"))


def repeated_starts(keyed, window=WINDOW, short=SHORT):
    """id, tie and starts: windows whose words also start earlier, gathered by document.

    Earlier is a smaller id, of one id a smaller tie, or the same document and a smaller
    start. Whole copies of an earlier document are left out; all their windows start earlier.
    """
    prefixes = _anchor_rows(keyed, window, short)
    twice = (
        prefixes.withColumn("n", F.count("*").over(Window.partitionBy("prefix")))
        .where("known or n > 1")
        .select("id", "tie", "start")
    )
    near = (
        keyed.join(_gathered(twice), ["id", "tie"])
        .join(_copies(keyed), ["id", "tie"], "left_anti")
        .select("id", "tie", "text", "starts")
    )
    suffixes = _suffix_rows(near, window, short)
    rank = F.rank().over(Window.partitionBy("node", "check").orderBy("id", "tie", "start"))
    return _gathered(
        suffixes.withColumn("rank", rank)
        .where("start < 0 or rank > 1")
        .select(
            "id",
            "tie",
            F.when(F.col("start") < 0, -1 - F.col("start")).otherwise(F.col("start")).alias("start"),
        )
    )


def _covered(n, starts, window):
    """Mask of the words that the windows from `starts` on cover."""
    edges = np.zeros(n + 1, dtype=np.int64)
    starts = np.unique(np.asarray(starts, dtype=np.int64))
    starts = starts[starts + window <= n]
    edges[starts] += 1
    edges[starts + window] -= 1
    return np.cumsum(edges)[:n] > 0


def deduplicated(docs, window=WINDOW, short=SHORT):
    """doc_id, n_words, n_removed, spans and kept (text) per row of `docs`.

    `spans` are the maximal repeats that were removed, as [first word, word after the last]
    in the input's words; `kept` are the other words joined by one space. Windows are judged
    on the input. Texts that are null, empty or shorter than a window lose nothing. A
    null id comes after all others (2^63 - 1 is read as null); rows that share an id, or have
    none, come in the order of `told_apart`. An empty table gives no
    rows.
    """
    keyed = _keyed(docs)
    starts = repeated_starts(keyed, window, short)
    kind = docs.schema["doc_id"].dataType.simpleString()
    doc_id = F.when(F.col("id") != LAST_ID, F.col("id")).cast(kind)

    def run(batches):
        for batch in batches:
            n_words, n_removed, spans, kept = [], [], [], []
            for text, found, copy in zip(*batch.columns[1:], strict=True):
                words = words_of(text.as_py())
                n_words.append(len(words))
                if copy.as_py() and len(words) >= window:
                    n_removed.append(len(words))
                    spans.append([[0, len(words)]])
                    kept.append(b"")
                    continue
                if not found.is_valid:
                    n_removed.append(0)
                    spans.append([])
                    kept.append(b" ".join(words))
                    continue
                gone = _covered(len(words), found.values.to_numpy(), window)
                n_removed.append(int(gone.sum()))
                turns = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                spans.append(turns.reshape(-1, 2).tolist())
                kept.append(b" ".join([words[i] for i in np.flatnonzero(~gone)]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(spans, pa.list_(pa.list_(pa.int32()))),
                    pa.array([k.decode("utf-8", "surrogatepass") for k in kept], pa.string()),
                ],
                names=["doc_id", "n_words", "n_removed", "spans", "kept"],
            )

    return (
        keyed.join(starts, ["id", "tie"], "left")
        .join(_copies(keyed), ["id", "tie"], "left")
        .select(doc_id.alias("doc_id"), "text", "starts", F.coalesce("copy", F.lit(False)).alias("copy"))
        .mapInArrow(
            run,
            f"doc_id {kind}, n_words long, n_removed long, spans array<array<int>>, kept string",
        )
    )


def report(found):
    """The columns of the query from the output of `deduplicated`."""
    return found.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )
