"""Nearest neighbours by inner product: a vantage-point tree per shard, searched block by block.

Rows are dealt to shards of a bounded size and each shard is built into a tree by one task.
Every block of queries then meets every shard; a piece of work is one tree and one block,
whatever the tables hold, and gives the best of its shard, from which the best of all are
ranked.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from daystar.llm.tables import stored
from daystar.llm.vp_tree import Nearest, Tree, build, fitted_factor

#: Bytes of the vectors of a shard and of a block of queries, in double precision.
SHARD_BYTES = 4 << 20
BLOCK_BYTES = 1 << 20
#: Relaxations of the triangle inequality that are tried, and the share of the best that one must find.
FACTORS = (1.5, 2.0, 3.0, 4.0, 6.0)
WANTED = 0.97


def _numbered(vectors, asked):
    """row, vec_id, asked, dims and embedding (double) of the vectors that take part, written once."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    good = F.coalesce(finite, F.lit(False)) & F.exists("embedding", lambda x: x != 0)
    return stored(
        vectors.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("vec_id").cast("long").alias("vec_id"),
            F.coalesce(asked, F.lit(False)).alias("asked"),
            F.size("embedding").alias("dims"),
            F.col("embedding").cast("array<double>").alias("embedding"),
        ).where(good),
        "vectors",
    )


def _matrix(column, dims):
    """Rows of an Arrow list column of equal lengths."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.ascontiguousarray(flat.flatten().to_numpy(zero_copy_only=False)).reshape(-1, dims)


def _trees(points):
    """dims, shard and the tree of each shard: vectors, ids, rows and bounds in binary columns."""

    def run(key, table):
        vectors = _matrix(table.column("embedding"), key[0].as_py())
        order, bounds = build(vectors)
        ids = table.column("vec_id")
        parts = (
            vectors[order],
            ids.fill_null(0).to_numpy()[order],
            ids.is_null().to_numpy()[order],
            table.column("row").to_numpy()[order],
            bounds,
        )
        return pa.table(
            {
                "dims": [key[0].as_py()],
                "shard": [key[1].as_py()],
                **{name: [part.tobytes()] for name, part in zip(_PARTS, parts, strict=True)},
            }
        ).cast(_TREE)

    return points.groupBy("dims", "shard").applyInArrow(
        run, "dims int, shard int, vectors binary, ids binary, nulls binary, rows binary, bounds binary"
    )


_PARTS = ("vectors", "ids", "nulls", "rows", "bounds")
_KINDS = (np.float64, np.int64, np.bool_, np.int64, np.float64)
_TREE = pa.schema([("dims", pa.int32()), ("shard", pa.int32()), *((name, pa.binary()) for name in _PARTS)])


def _tree(table, dims, row=0):
    vectors, ids, nulls, rows, bounds = (
        np.frombuffer(table.column(name)[row].as_py(), dtype=kind)
        for name, kind in zip(_PARTS, _KINDS, strict=True)
    )
    return Tree(vectors.reshape(-1, dims), ids, nulls, rows, bounds.reshape(-1, 4))


def _factors(trees, k, factors, wanted):
    """dims and factor, measured on the first shard of each length of vectors."""

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                dims = batch.column("dims")[row].as_py()
                fitted = fitted_factor(_tree(batch, dims, row), k, factors, wanted)
                yield pa.RecordBatch.from_arrays([pa.array([dims], pa.int32()), pa.array([fitted])], names=["dims", "factor"])

    return trees.where("shard = 0").mapInArrow(run, "dims int, factor double")


def nearest(vectors, asked, k=20, factors=FACTORS, wanted=WANTED):
    """query_id, rank, vec_id and score: the k rows of greatest inner product with each asked row.

    `vectors` has vec_id and embedding (floats or doubles); `asked` is a condition on its columns. All
    rows but the query's own are candidates, nearest first, ties to the smaller vec_id, a null
    one last; all of them if they are fewer than k. Scores are inner products of the given
    vectors, summed in double precision. Null, zero, empty vectors and those that hold nulls or
    non-finite numbers take no part; vectors of different length never meet. Repeated rows are
    rows of their own: an asked id that occurs twice is answered twice. Other columns are not
    read; no rows give no rows.

    `factors` relax the triangle inequality (see `vp_tree`): the greatest that finds a share `wanted` of the best
    is used, measured on 256 vectors of the first shard, a random one. With `factors=()`
    results are exact. All rows are indexed, in trees of SHARD_BYTES of vectors.
    """
    numbered = _numbered(vectors, asked)
    width = F.col("dims") * 8
    sizes = stored(
        numbered.groupBy("dims")
        .agg(F.count("*").alias("n"), F.count_if("asked").alias("q"))
        .where("q > 0")
        .select(
            "dims",
            F.ceil(F.col("n") * width / SHARD_BYTES).cast("int").alias("shards"),
            F.ceil(F.col("q") * width / BLOCK_BYTES).cast("int").alias("blocks"),
        ),
        "vector-sizes",
    )
    # `sizes` has a row per length of vectors; the planner sees how small its file is.
    sized = numbered.join(sizes, "dims")
    shard = F.pmod(F.xxhash64("row"), F.col("shards")).cast("int")
    trees = stored(_trees(sized.withColumn("shard", shard)), "vector-trees")
    fitted = stored(_factors(trees, k, factors, wanted), "vector-factors")
    spread = (
        trees.join(sizes, "dims")
        .join(fitted, "dims", "left")
        .withColumn("factor", F.coalesce("factor", F.lit(1.0)))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    )
    queries = (
        sized.where("asked")
        .withColumn("block", F.pmod(F.xxhash64("row", F.lit(1)), F.col("blocks")).cast("int"))
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    )

    def run(key, tree_rows, block):
        if not tree_rows.num_rows or not block.num_rows:
            return _FOUND.empty_table()
        dims = key[0].as_py()
        tree = _tree(tree_rows, dims)
        best = Nearest(_matrix(block.column("embedding"), dims), block.column("row").to_numpy(), k)
        tree.search(best, tree_rows.column("factor")[0].as_py())
        query, place = np.nonzero(best.found >= 0)
        return pa.table(
            [
                pa.array(best.rows[query]),
                block.column("vec_id").take(pa.array(query)).combine_chunks(),
                pa.array(best.ids[query, place], mask=best.nulls[query, place]),
                pa.array(best.found[query, place]),
                pa.array(best.scores[query, place]),
            ],
            schema=_FOUND,
        )

    keys = ["dims", "shard", "block"]
    found = (
        spread.groupBy(*keys)
        .cogroup(queries.select(*keys, "row", "vec_id", "embedding").groupBy(*keys))
        .applyInArrow(run, "query long, query_id long, vec_id long, row long, score double")
    )
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


_FOUND = pa.schema(
    [("query", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("row", pa.int64()), ("score", pa.float64())]
)
