"""SimHash near-duplicates, searched by the general pigeonhole principle.

The 64 bits of the fingerprints are cut into parts, correlated bits together. Parts get
thresholds that add up to (distance - parts + 1); two fingerprints within the distance are
then within the threshold in at least one part, -1 meaning that a part is not probed.
Every fingerprint chooses its own thresholds by dynamic programming on the number of
candidates that each would bring, so it avoids the parts in which its value is common.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from daystar.llm.components import components
from daystar.llm.tables import stored

BITS = 64
PARTS = 4
PART_BITS = BITS // PARTS
# One probe costs about as much as this many candidates.
PROBE_COST = 2.0
# Hashes whose bits are spread out at once, for texts of many words.
_SLICE = 1 << 15


def fingerprint(text, shingle=3, seed=42):
    """SimHash of the word shingles of a text, as 8 bytes, most significant bit first.

    A-Z are lower-cased, words are runs of anything but ASCII blanks, repeats count. Fewer
    words than `shingle` make one shingle of all, no words make the fingerprint zero. A bit
    is 1 if more than half of the hashes have it.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return bytes(8)
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, seed) for s in shingles), dtype=np.uint64)
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), _SLICE):
        own = hashes[at : at + _SLICE].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(own, axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(hashes)).tobytes()


def fingerprints(docs, text="text", keep=("doc_id",), shingle=3):
    """Columns `keep` and the fingerprint of every whole text as a long, named `print`.

    Null and empty texts have the fingerprint zero.
    """
    source = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("print"))
    kinds = ", ".join(
        f"`{field.name}` {field.dataType.simpleString()}" for field in source.schema[: len(keep)]
    )

    def run(batches):
        for batch in batches:
            packed = b"".join(fingerprint(v.as_py(), shingle) for v in batch.column(len(keep)))
            column = pa.array(np.frombuffer(packed, dtype=">i8").astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], column], names=[*keep, "print"]
            )

    return source.mapInArrow(run, f"{kinds}, print long")


def bit_groups(prints, parts=PARTS):
    """The bits of each part, correlated ones together.

    How often two bits are 1 together is counted over all rows of `prints`: tasks add up
    64 x 64 counts, Spark adds up the tasks'. Each part starts with the bit that is most
    correlated to the others left and takes those most correlated to it in turn.
    """

    def partial(batches):
        both, n = np.zeros((BITS, BITS)), 0
        for batch in batches:
            bits = _bits(batch.column(0).to_numpy(zero_copy_only=False)).astype(np.float64)
            both += bits.T @ bits
            n += len(bits)
        cells = np.append(both.ravel(), n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(cells))), pa.array(cells)], names=["cell", "n"]
        )

    counted = (
        prints.select("print")
        .mapInArrow(partial, "cell long, n double")
        .groupBy("cell")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    cells = np.zeros(BITS * BITS + 1)
    for row in counted:
        cells[row.cell] = row.n
    n = max(cells[-1], 1)
    both = cells[:-1].reshape(BITS, BITS) / n
    ones = np.diag(both)
    spread = np.sqrt(np.maximum(ones * (1 - ones), 1e-12))
    related = np.abs(both - np.outer(ones, ones)) / np.outer(spread, spread)
    np.fill_diagonal(related, 0)
    left, groups = list(range(BITS)), []
    while left:
        group = [max(left, key=lambda bit: related[bit, left].sum())]
        left.remove(group[0])
        while len(group) < BITS // parts:
            bit = max(left, key=lambda b: related[b, group].sum())
            group.append(bit)
            left.remove(bit)
        groups.append(group)
    return groups


def _bits(prints):
    """Matrix of bits, one row per fingerprint, most significant first."""
    return np.unpackbits(prints.astype(">i8").view(np.uint8).reshape(-1, 8), axis=1)


def part_values(prints, groups):
    """Value of every part, one column per part."""
    bits = _bits(prints).astype(np.int64)
    weights = 1 << np.arange(PART_BITS)
    return np.stack([bits[:, group] @ weights for group in groups], axis=1)


def _with_parts(prints, groups):
    """Rows (part, value, print): four per fingerprint, the side that is probed."""

    def run(batches):
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False)
            values = part_values(own, groups)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.tile(np.arange(PARTS, dtype=np.int32), len(own))),
                    pa.array(values.ravel().astype(np.int32)),
                    pa.array(np.repeat(own, PARTS)),
                ],
                names=["part", "value", "print"],
            )

    return prints.select("print").mapInArrow(run, "part int, value int, print long")


def ball_counts(counts, most):
    """For every value the number of fingerprints within 0..most bits of it in this part.

    Sums over Hamming shells, by a Walsh-Hadamard transform: in that basis a shell is a
    multiplication.
    """
    size = len(counts)
    order = np.array([bin(i).count("1") for i in range(size)])

    def transform(values):
        values, half = values.copy(), 1
        while half < size:
            pairs = values.reshape(-1, 2, half)
            values = np.stack(
                [pairs[:, 0] + pairs[:, 1], pairs[:, 0] - pairs[:, 1]], axis=1
            ).reshape(-1)
            half *= 2
        return values

    spectrum = transform(counts.astype(np.float64))
    within = [
        np.rint(transform(spectrum * transform((order <= radius).astype(np.float64))) / size)
        for radius in range(most + 1)
    ]
    return np.stack(within)


def choose_thresholds(costs, total):
    """Thresholds of least cost, one row per fingerprint.

    `costs[:, i, t]` is the cost of threshold t - 1 in part i. Thresholds of -1 or more
    must add up to `total`: dynamic programming over the parts and the sum so far.
    """
    n, parts, choices = costs.shape
    goal = total + parts
    best = np.full((n, goal + 1), np.inf)
    best[:, 0] = 0
    came = np.zeros((parts, n, goal + 1), dtype=np.int8)
    for part in range(parts):
        now = np.full((n, goal + 1), np.inf)
        for choice in range(min(choices, goal + 1)):
            moved = best[:, : goal + 1 - choice] + costs[:, part, choice, None]
            better = moved < now[:, choice:]
            now[:, choice:][better] = moved[better]
            came[part][:, choice:][better] = choice
        best = now
    chosen = np.zeros((n, parts), dtype=np.int64)
    rest = np.full(n, goal)
    for part in reversed(range(parts)):
        chosen[:, part] = came[part][np.arange(n), rest]
        rest -= chosen[:, part]
    return chosen - 1


def _flips(most):
    """By threshold the masks that turn a value into every value within it."""
    masks = [
        sum(1 << bit for bit in bits)
        for radius in range(most + 1)
        for bits in combinations(range(PART_BITS), radius)
    ]
    sizes = [sum(1 for m in masks if bin(m).count("1") <= r) for r in range(most + 1)]
    return np.array(masks, dtype=np.int64), sizes


def _probes(prints, groups, within, distance):
    """Rows (part, value, print): every part value that a fingerprint has to look up."""
    masks, sizes = _flips(distance)

    def run(batches):
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False)
            values = part_values(own, groups)
            costs = np.zeros((len(own), PARTS, distance + 2))
            for part in range(PARTS):
                for radius in range(distance + 1):
                    costs[:, part, radius + 1] = (
                        PROBE_COST * sizes[radius] + within[part][radius][values[:, part]]
                    )
            chosen = choose_thresholds(costs, distance - PARTS + 1)
            for part in range(PARTS):
                for radius in range(distance + 1):
                    rows = np.flatnonzero(chosen[:, part] == radius)
                    # A few thousand rows at a time: wide thresholds make hundreds of probes.
                    for at in range(0, len(rows), 4096):
                        some = rows[at : at + 4096]
                        near = values[some, part][:, None] ^ masks[None, : sizes[radius]]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(near.size, part, dtype=np.int32)),
                                pa.array(near.ravel().astype(np.int32)),
                                pa.array(np.repeat(own[some], sizes[radius])),
                            ],
                            names=["part", "value", "print"],
                        )

    return prints.select("print").mapInArrow(run, "part int, value int, print long")


def _near(distance):
    return F.bit_count(F.col("print").bitwiseXOR(F.col("other"))) <= distance


def links(prints, distance=3):
    """Edges (a, b) between different fingerprints that join all those within `distance`.

    Every two fingerprints within the distance end up in one component of the edges, and
    every edge is within it. In each bucket all fingerprints are first compared with its
    least and its greatest one: that ties together groups of near copies by as many edges
    as they have members. The probes then compare only fingerprints that are not yet in
    one component, and buckets that lie within one component drop out, so a large group
    brings no list of its pairs.
    """
    index = stored(prints, "prints")
    groups = bit_groups(index)
    parts = stored(_with_parts(index, groups), "print-parts")
    buckets = parts.groupBy("part", "value").agg(
        F.count("*").alias("n"), F.min("print").alias("least"), F.max("print").alias("greatest")
    )
    counts = np.zeros((PARTS, 1 << PART_BITS))
    # At most 4 x 65,536 rows, whatever the number of fingerprints.
    for part, value, n in buckets.select("part", "value", "n").toPandas().itertuples(index=False):
        counts[part, value] = n
    within = [ball_counts(own, distance) for own in counts]

    ends = parts.join(buckets.where("n > 1"), ["part", "value"]).select(
        "print", F.explode(F.array("least", "greatest")).alias("other")
    )
    stars = stored(
        ends.where(F.col("print") != F.col("other")).where(_near(distance)).distinct(), "stars"
    )
    tied = components(stars, "print", "other")
    labelled = stored(
        index.join(tied, F.col("print") == F.col("node"), "left").select(
            "print", F.coalesce("component", "print").alias("component")
        ),
        "labelled",
    )
    members = parts.join(labelled, "print")
    probes = _probes(index, groups, within, distance).join(labelled, "print")
    mixed = members.groupBy("part", "value").agg(
        F.min("component").alias("low"), F.max("component").alias("high")
    )
    sought = probes.join(mixed, ["part", "value"]).where(
        (F.col("low") != F.col("high")) | (F.col("low") != F.col("component"))
    )
    found = sought.select(
        "part", "value", F.col("print").alias("other"), F.col("component").alias("theirs")
    ).join(members, ["part", "value"])
    crossing = found.where((F.col("component") != F.col("theirs")) & _near(distance))
    return stars.select(F.col("print").alias("a"), F.col("other").alias("b")).union(
        crossing.select(F.col("print").alias("a"), F.col("other").alias("b")).distinct()
    )


def near_duplicates(docs, shingle=3, distance=3):
    """doc_id, fingerprint (16 hex digits) and component_id per row of `docs`.

    Documents are linked when their fingerprints differ in `distance` bits or fewer;
    component_id is the least doc_id that links reach. Equal fingerprints are one node, so
    copies cost nothing beyond their count. Null and empty texts have the fingerprint zero
    and are linked like others; a null doc_id belongs to its component and never names it
    unless there is no other; an empty table gives no rows.
    """
    prints = stored(fingerprints(docs, shingle=shingle), "fingerprints")
    nodes = stored(prints.groupBy("print").agg(F.min("doc_id").alias("first")), "nodes")
    tied = components(links(nodes.select("print"), distance))
    labelled = nodes.join(tied, F.col("print") == F.col("node"), "left").select(
        "print", "first", F.coalesce("component", "print").alias("component")
    )
    names = labelled.groupBy("component").agg(F.min("first").alias("component_id"))
    by_print = stored(
        labelled.join(names, "component").select("print", "component_id"), "print-components"
    )
    return prints.join(by_print, "print").select(
        "doc_id",
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def keep_first(docs, shingle=3, distance=3):
    """Rows of `docs`, all columns, of one document per group: the one with the least id.

    Rows that repeat an id are one document and stay or go together; rows with a null id
    stay where their whole group has none.
    """
    found = near_duplicates(docs, shingle, distance)
    kept = (
        found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .select(F.col("doc_id").alias("kept_id"))
        .distinct()
    )
    return docs.join(kept, docs["doc_id"].eqNullSafe(F.col("kept_id")), "left_semi")
