"""Secret scans: fixed patterns, and character Markov models compared by likelihood.

Order-1 character models of random strings and of ordinary ones are trained on labelled
samples. Random are strings of the usual alphabets and what the fixed patterns find in the documents; ordinary
are identifiers put together from words, and the documents' shorter runs of token
characters. A long run that no pattern covers is a further span when the likeliest random model
is so much likelier than the likeliest ordinary one.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from daystar.llm.secret_samples import ALPHABETS, labelled

#: Kinds in the order that ties at one start follow.
KINDS = ("assign", "access", "hex", "markov")

# The patterns of the base kinds, and the least length of what they find.
# ASCII and either case: no letter beyond A-Z folds to one of theirs.
_ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ASSIGN_LENGTH, ACCESS_LENGTH, HEX_LENGTH = 6, 20, 24
# Of a maximal run of hex digits that is too short no part could pass either.
_HEX = re.compile(r"[0-9a-f]{%d,}" % HEX_LENGTH)

#: Characters that tokens are made of; state 0 stands for all others.
TOKEN = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
STATES = len(TOKEN) + 1
_STATE = np.zeros(128, dtype=np.int64)
_STATE[[ord(c) for c in TOKEN]] = np.arange(1, STATES)
#: Runs of token characters from this length on are candidates and teach neither model.
LEAST = 16
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST)
_LETTER = re.compile(r"[A-Za-z]")
#: Labelled strings of each kind that are drawn for training.
SAMPLES = 20_000
#: Log-likelihood ratio that a run must exceed. On 20,000 held-out strings of each kind, of 20 characters and
#: more and with words that training has not seen, precision and recall are 1.000.
LIMIT = 10.0


def base_spans(text):
    """(start, end, kind, value start) of the fixed patterns, per kind leftmost first."""
    found = [
        (m.start(), m.end(), 0, m.start(2))
        for m in _ASSIGN.finditer(text)
        if m.end(2) - m.start(2) >= ASSIGN_LENGTH
    ]
    found += [
        (m.start(), m.end(), 1, m.start())
        for m in _ACCESS.finditer(text)
        if m.end() - m.start() >= ACCESS_LENGTH
    ]
    found += [(m.start(), m.end(), 2, m.start()) for m in _HEX.finditer(text)]
    return sorted(found)


def states(text):
    """State number of every code point."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return _STATE[np.where(points < 128, points, 0)]


def count_pairs(text):
    """Numbers of neighbouring states, [random, ordinary], of one text.

    Pairs that reach from or to a character outside tokens belong to neither sample, nor
    do runs long enough to be candidates; a base span counts for the random one only.
    """
    state = states(text)
    random = np.zeros(STATES * STATES, dtype=np.int64)
    base = base_spans(text)
    for _, end, _, value in base:
        own = state[value:end]
        random += np.bincount(own[:-1] * STATES + own[1:], minlength=STATES * STATES)
    for start, end, _, _ in base:
        state[start:end] = 0
    for run in _RUN.finditer(text):
        state[run.start() : run.end()] = 0
    ordinary = np.bincount(state[:-1] * STATES + state[1:], minlength=STATES * STATES)
    return np.stack([random, ordinary])


@dataclass(frozen=True)
class Model:
    """Log probabilities of a state after another, for each random and each ordinary model."""

    random: tuple
    ordinary: tuple

    def score(self, state):
        """Log-likelihood ratio of the likeliest random model to the likeliest ordinary one."""
        before, after = state[:-1], state[1:]
        best = [max(float(model[before, after].sum()) for model in kind) for kind in (self.random, self.ordinary)]
        return best[0] - best[1]


def _fitted(counts, smoothing, uniform):
    """Log probabilities of one model from its counts of neighbouring states.

    After a character that a sample has seldom or never, its usual characters count. `uniform` is the
    share that is the same for every character.
    """
    counts = counts.reshape(STATES, STATES)[1:, 1:].astype(float)
    single = counts.sum(axis=0) + smoothing
    steps = counts + smoothing * (STATES - 1) * (single / single.sum())
    steps /= steps.sum(axis=1, keepdims=True)
    fitted = np.zeros((STATES, STATES))
    fitted[1:, 1:] = np.log((1 - uniform) * steps + uniform / (STATES - 1))
    return fitted


@lru_cache(maxsize=1)
def sample_counts():
    """Counts of neighbouring states in the labelled sample, by alphabet, and by None for identifiers."""
    counts = {name: np.zeros(STATES * STATES, dtype=np.int64) for name in (*ALPHABETS, None)}
    for text, name in labelled(SAMPLES, LEAST, seed=11):
        state = states(text)
        np.add.at(counts[name], state[:-1] * STATES + state[1:], 1)
    return counts


def train(docs, text="text", smoothing=1.0, uniform=0.02):
    """Fit the models on the labelled sample and on all rows of `docs`.

    Tasks add up their counts, Spark adds up those of the tasks: the driver gets 2 x 68 x 68
    numbers at any size. `smoothing` counts per character are spread as each sample's characters
    are. Null and empty texts count nothing; without any the labelled sample alone decides.
    """
    cells = 2 * STATES * STATES

    def partial(batches):
        total = np.zeros((2, STATES * STATES), dtype=np.int64)
        for batch in batches:
            for value in batch.column(0):
                total += count_pairs(value.as_py())
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(cells)), pa.array(total.ravel())], names=["cell", "n"]
        )

    counted = (
        docs.where(F.length(text) > 1)
        .select(F.col(text))
        .mapInArrow(partial, "cell long, n long")
        .where("n > 0")
        .groupBy("cell")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    counts = np.zeros(cells)
    for row in counted:
        counts[row.cell] = row.n
    found, shorter = counts.reshape(2, STATES * STATES)
    sample = sample_counts()
    random, ordinary = [sample[name] for name in ALPHABETS], [sample[None]]
    if found.any():
        random.append(found)
    if shorter.any():
        # On top of the identifiers, so that a few documents do not make anything look ordinary.
        ordinary.append(shorter + sample[None])
    return Model(
        *(tuple(_fitted(own, smoothing, uniform) for own in kind) for kind in (random, ordinary))
    )


def markov_spans(text, model, base, limit=LIMIT):
    """Runs of `LEAST` or more token characters outside `base` whose log-likelihood ratio exceeds `limit`."""
    found = []
    taken = sorted((start, end) for start, end, _, _ in base)
    starts, ends = [start for start, _ in taken], list(accumulate((end for _, end in taken), max))
    for run in _RUN.finditer(text):
        start, end = run.span()
        # Card and phone numbers are as random as keys, and no secrets of this kind.
        if not _LETTER.search(run.group()):
            continue
        before = bisect_left(starts, end)
        if before and ends[before - 1] > start:
            continue
        state = _STATE[np.frombuffer(run.group().encode("ascii"), np.uint8)]
        if model.score(state) > limit:
            found.append((start, end, 3, start))
    return found


def spans(text, model, limit=LIMIT):
    """All spans of a text as (start, end, kind), by start and kind."""
    base = base_spans(text)
    found = base + markov_spans(text, model, base, limit)
    return sorted(((s, e, k) for s, e, k, _ in found), key=lambda x: (x[0], x[2], x[1]))


_SPAN = "array<struct<kind: string, start: int, end: int>>"


def scan(docs, model, text="text", keep=("doc_id",), limit=LIMIT):
    """Columns `keep` and `spans`, an array of (kind, start, end), for every row of `docs`.

    Offsets are code points of the whole text, the end exclusive; the array is ordered by
    start and then by `KINDS`. Null and empty texts have an empty array. One pass without
    a shuffle.
    """
    source = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("spans"))
    kinds = ", ".join(
        f"`{field.name}` {field.dataType.simpleString()}" for field in source.schema[: len(keep)]
    )
    span = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    )

    def run(batches):
        for batch in batches:
            found = [
                [
                    {"kind": KINDS[k], "start": s, "end": e}
                    for s, e, k in spans(value.as_py(), model, limit)
                ]
                for value in batch.column(len(keep))
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(found, span)], names=[*keep, "spans"]
            )

    return source.mapInArrow(run, f"{kinds}, spans {_SPAN}")


def report(scanned):
    """The columns of the query from the output of `scan`."""
    joined = "array_join(transform({}, x -> concat_ws(':', x.kind, x.start, x.end)), ',')"
    base = "filter(spans, x -> x.kind <> 'markov')"
    count = "cast(size(filter(spans, x -> x.kind = '{}')) as long)"
    return scanned.select(
        "doc_id",
        *(F.expr(count.format(kind)).alias(f"n_{kind}") for kind in KINDS),
        F.sha2(F.expr(joined.format(base)).cast("binary"), 256).alias("base_sha256"),
        F.expr(joined.format("spans")).alias("spans"),
    )
