"""Embedding near-duplicates by spherical-cap filters from a structured random product code.

Filter directions are concatenations of short random codewords, one per block of
dimensions, so a vector meets an exponential number of directions through a few dozen inner
products per block. A vector is list-decoded to all directions whose inner product with it
exceeds a limit; vectors that share a direction are candidates and are verified by their
cosine. Two vectors at a small angle share most of theirs, others share none.
"""

from __future__ import annotations

from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from daystar.llm.components import components
from daystar.llm.tables import stored

BLOCKS = 4
#: Codewords per block: 24^4, about 330,000 directions.
CODEWORDS = 24
#: Directions of a code that a random vector exceeds on average; the limit follows from it.
WANTED = 24
#: Codes with rotations of their own.
CODES = 2
SEED = 20240501
#: Rows of a block that is compared at once.
TILE = 1024
#: Rows of small directions that are compared together, about.
PIECE = 256


def code(dimensions, blocks=BLOCKS, codewords=CODEWORDS, seed=SEED):
    """A random rotation and the codewords of each block, unit vectors."""
    draw = np.random.default_rng(seed)
    rotation, _ = np.linalg.qr(draw.standard_normal((dimensions, dimensions)))
    words = []
    for part in np.array_split(np.arange(dimensions), blocks):
        own = draw.standard_normal((codewords, len(part)))
        words.append(own / np.maximum(np.linalg.norm(own, axis=1, keepdims=True), 1e-12))
    return rotation, words


def limit_for(dimensions, blocks=BLOCKS, codewords=CODEWORDS, wanted=WANTED):
    """The inner product that `wanted` of all directions exceed for a random unit vector."""
    share = min(wanted / codewords**blocks, 0.5)
    return -NormalDist().inv_cdf(share) / np.sqrt(dimensions)


def decode(vector, rotation, words, limit, margin):
    """Numbers of all directions whose inner product with a unit vector exceeds `limit`.

    Some vectors lie badly for a code and exceed few limits or none. For them the limit is
    `margin` below their best direction, the distance that a neighbour's product may differ
    by, so they share directions with their neighbours too. Block by block; a start of a
    direction is given up when the best ends of the other blocks cannot lift it over the
    limit.
    """
    turned = vector @ rotation
    scale = 1 / np.sqrt(len(words))
    scores, at = [], 0
    for own in words:
        scores.append(own @ turned[at : at + own.shape[1]] * scale)
        at += own.shape[1]
    best_after = np.append(np.cumsum([s.max() for s in scores[::-1]])[::-1], 0.0)
    limit = min(limit, best_after[0] - margin)
    sums, numbers = np.zeros(1), np.zeros(1, dtype=np.int64)
    for own, rest in zip(scores, best_after[1:], strict=True):
        total = sums[:, None] + own[None, :]
        row, word = np.nonzero(total + rest > limit)
        sums = total[row, word]
        numbers = numbers[row] * len(own) + word
    return numbers


def _units(column):
    """Vectors of an Arrow list column as unit rows in double precision."""
    x = np.array([v.values.to_numpy(zero_copy_only=False) for v in column], dtype=np.float64)
    # Scaled first, so that no square overflows or vanishes.
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def usable(vectors):
    """The vectors that can link: label and vector not null, finite, not zero, of some length."""
    finite = F.forall(
        "embedding",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))),
    )
    return vectors.where(
        F.col("label").isNotNull()
        & F.coalesce(finite, F.lit(False))
        & F.exists("embedding", lambda x: x != 0)
    )


def classes(vectors):
    """label, embedding, rep, least and copies: equal vectors of a label as one row.

    `rep` is the number of one of their rows, `least` their least vec_id; null if none has one.
    """
    return vectors.groupBy("label", "embedding").agg(
        F.min("row").alias("rep"), F.min("vec_id").alias("least"), F.count("*").alias("copies")
    )


def filters(reps, least):
    """label, size (dimensions), direction and rep: every direction of every vector."""

    def decoder(size):
        codes = [code(size, seed=SEED + i) for i in range(CODES)]
        limit = limit_for(size)
        margin = 1.2 * np.sqrt((1 - least * least) / size)

        def directions(unit):
            found = [decode(unit, *own, limit, margin) * CODES + i for i, own in enumerate(codes)]
            return np.concatenate(found)

        return directions

    def run(batches):
        decoders = {}
        for batch in batches:
            labels, embeddings, ids = batch.columns
            rows, found = [], []
            sizes = np.array([len(v) for v in embeddings])
            for size in np.unique(sizes):
                own = np.flatnonzero(sizes == size)
                decoders.setdefault(size, decoder(size))
                for row, unit in zip(own, _units(embeddings.take(pa.array(own))), strict=True):
                    found.append(decoders[size](unit))
                    rows.append(np.full(len(found[-1]), row))
            rows = np.concatenate([np.zeros(0, np.int64), *rows])
            found = np.concatenate([np.zeros(0, np.int64), *found])
            take = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [
                    labels.take(take),
                    pa.array(sizes[rows].astype(np.int32)),
                    pa.array(found),
                    ids.take(take),
                ],
                names=["label", "size", "direction", "rep"],
            )

    kind = reps.schema["label"].dataType.simpleString()
    return reps.select("label", "embedding", "rep").mapInArrow(
        run, f"label {kind}, size int, direction long, rep long"
    )


def in_tiles(rows, groups, keys):
    """`rows` of `groups` (keys and n), once for every pair of tiles they belong to.

    A group of n rows is cut into tiles by hash of `rep`; each pair of tiles, named by one
    and two, is a task's piece of the group, so no piece holds more than about 2 x TILE rows
    however large the group is.
    """
    sized = groups.select(*keys, F.ceil(F.col("n") / TILE).cast("int").alias("tiles"))
    return (
        rows.join(sized, keys)
        .withColumn("tile", F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int"))
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .withColumn("one", F.least("tile", "with"))
        .withColumn("two", F.greatest("tile", "with"))
        .drop("tiles", "with")
    )


def _component_edges(ids, near):
    """One edge from every row to the least of its component in a link matrix."""
    order = np.argsort(ids)
    near = near[np.ix_(order, order)]
    label = np.arange(len(order))
    while True:
        # The least label of a row and its links; rows are in the order of their ids.
        lower = np.minimum(label, np.where(near, label[None, :], len(label)).min(axis=1))
        lower = lower[lower]
        if (lower == label).all():
            break
        label = lower
    rows = np.flatnonzero(label != np.arange(len(label)))
    return ids[order][rows], ids[order][label[rows]]


def candidate_edges(reps, found, least):
    """Edges (a, b) that join the vectors of each direction as their links do.

    Candidates are verified by cosine. Every vector gives at most one edge per piece: to
    the least one that verified links reach, so a direction of many near copies never lists
    its pairs.
    """
    keys = ["label", "size", "direction"]
    counted = found.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    busy = stored(counted, "busy-directions")
    small = busy.where(F.col("n") <= PIECE)
    total = small.agg(F.sum("n")).first()[0] or 0
    # Small directions share a piece; what they hold together is compared by direction.
    pieces = F.pmod(F.xxhash64("direction"), F.lit(int(total) // PIECE + 1))
    rows = (
        found.join(small.select(*keys), keys, "left_semi")
        .withColumn("piece", pieces)
        .withColumn("one", F.lit(0))
        .withColumn("two", F.lit(0))
    )
    large = in_tiles(found, busy.where(F.col("n") > PIECE), keys)
    rows = rows.unionByName(large.drop("tile").withColumn("piece", -1 - F.col("direction"))).join(
        reps.select("rep", "embedding"), "rep"
    )

    def run(table):
        ids = table.column("rep").to_numpy()
        directions = table.column("direction").to_numpy()
        units = _units(table.column("embedding").combine_chunks())
        near = (units @ units.T >= least) & (directions[:, None] == directions[None, :])
        a, b = _component_edges(ids, near)
        return pa.table({"a": pa.array(a), "b": pa.array(b)})

    pieced = rows.groupBy("label", "size", "piece", "one", "two")
    return pieced.applyInArrow(run, "a long, b long").where("a <> b").distinct()


def link_counts(reps, members, least):
    """rep and n: vectors (copies counted) that each vector links to, in its component.

    All links of a vector lie within its component, so the components are compared exactly,
    pair of tiles by pair of tiles; counts are added up and no list of pairs is made.
    """
    groups = members.groupBy("component").agg(F.count("*").alias("n")).where("n > 1")
    rows = in_tiles(members, groups, ["component"]).join(
        reps.select("rep", "embedding", "copies"), "rep"
    )

    def run(key, table):
        ids = table.column("rep").to_numpy()
        copies = table.column("copies").to_numpy()
        units = _units(table.column("embedding").combine_chunks())
        tile = table.column("tile").to_numpy()
        counts = np.zeros(len(ids), dtype=np.int64)
        for at in range(0, len(ids), TILE):
            near = units[at : at + TILE] @ units.T >= least
            own = np.arange(at, min(at + TILE, len(ids)))
            if key[1].as_py() != key[2].as_py():
                near &= tile[own][:, None] != tile[None, :]
            else:
                near[np.arange(len(own)), own] = False
            counts[own] += near @ copies
        return pa.table({"rep": pa.array(ids), "n": pa.array(counts)})

    counted = rows.groupBy("component", "one", "two").applyInArrow(run, "rep long, n long")
    return counted.groupBy("rep").agg(F.sum("n").alias("n"))


def near_duplicates(vectors, least=0.98):
    """vec_id, n_links, component_id and kept per row of `vectors` (vec_id, embedding, label).

    Vectors link when their labels are equal and not null and their cosine, in double
    precision, is at least `least`. Null, zero and non-finite vectors, and those without a
    label, link with nothing and are their own component. Equal vectors of a label are one
    class: its copies link with each other and share its other links. Vectors of different
    length never link. Rows that repeat a vec_id, or have none, are vectors of their own and have a
    row each. A component goes by its least vec_id, and has none if no row in it does; `kept` says
    whether a row's vec_id is that one, two nulls being the same. Other columns are not read; an
    empty table gives no rows.
    """
    # Rows are told apart by a number of their own, which stays once it is written.
    numbered = stored(
        vectors.select(F.monotonically_increasing_id().alias("row"), "vec_id", "embedding", "label"), "vectors"
    )
    good = usable(numbered)
    reps = stored(classes(good), "vector-classes")
    found = stored(filters(reps, least), "vector-filters")
    edges = stored(candidate_edges(reps, found, least), "vector-edges")
    tied = components(edges)
    members = stored(
        reps.select("rep", "least")
        .join(tied, F.col("rep") == F.col("node"), "left")
        .select("rep", "least", F.coalesce("component", "rep").alias("component")),
        "vector-components",
    )
    names = members.groupBy("component").agg(F.min("least").alias("component_id"))
    counts = link_counts(reps, members.drop("least"), least)
    classed = (
        reps.drop("least")
        .join(members.drop("least"), "rep")
        .join(names, "component")
        .join(counts, "rep", "left")
        .select(
            "label",
            "embedding",
            "component_id",
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"),
        )
    )
    linked = good.join(classed, ["label", "embedding"]).select("row", "n", "component_id")
    return (
        numbered.select("row", "vec_id")
        .join(linked, "row", "left")
        .select(
            "vec_id",
            F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
            F.when(F.col("n").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )
