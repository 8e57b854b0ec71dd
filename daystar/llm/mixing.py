"""Mixing sources to target weights by hash thresholds, without a sort.

Every document has a point on a line of 2^60, a hash of its id. A source that shall give
part of its words gives the documents below a threshold. The threshold comes from
histograms: words by source and hash bucket; the bucket in which the running sum crosses
the budget is cut into finer buckets, and only its documents are counted again.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from daystar.llm.tables import WORD, stored, text_or_empty

POINT_BITS = 60
BUCKET_BITS = 10


def point(doc_id="doc_id", seed="mix"):
    """Place of a document, 0 to 2^60 - 1; a null id has one too."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, POINT_BITS // 4), 16, 10).cast("long")


def word_count(text="text"):
    """Words of a whole text; a null text has none."""
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def sized(docs):
    """doc_id, source, size and point of every document, the narrow table of all passes."""
    return docs.select(
        "doc_id", "source", word_count().alias("size"), point().alias("point")
    )


def source_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """source, source_size and target of every source.

    Sources by code point, null last, weigh `weights` in turn and share `share` times all
    sizes. No target exceeds `most` times its source's size; the excess goes to the others
    by weight until none is above. With targets as min(weight x level, limit) that ends at
    one level, and sources sorted by limit / weight reach their limit in that order, so
    running sums find it. This table has one row per source, the only rows that meet in
    one task. An empty table has no sources.
    """
    everything = Window.partitionBy()
    named = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn(
            "rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
        )
    )
    turn = F.array(*(F.lit(float(w)) for w in weights))
    weighed = named.select(
        "source",
        "source_size",
        F.element_at(turn, ((F.col("rank") - 1) % len(weights) + 1).cast("int")).alias("weight"),
        (F.col("source_size") * F.lit(float(most))).alias("limit"),
        (F.sum("source_size").over(everything) * F.lit(float(share))).alias("budget"),
        "rank",
    ).withColumn("order", F.struct(F.col("limit") / F.col("weight"), F.col("rank")))
    rising = Window.orderBy("order")
    left = weighed.select(
        "*",
        (
            F.col("budget")
            - F.coalesce(
                F.sum("limit").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)
            )
        ).alias("rest"),
        F.sum("weight").over(rising.rowsBetween(0, Window.unboundedFollowing)).alias("sharing"),
    )
    level = F.min(
        F.when(
            F.col("weight") * F.col("rest") / F.col("sharing") <= F.col("limit"),
            F.struct("order", "rest", "sharing"),
        )
    ).over(everything)
    return left.withColumn("level", level).select(
        "source",
        "source_size",
        F.when(
            F.col("level").isNull() | (F.col("order") < F.col("level.order")), F.col("limit")
        )
        .otherwise(F.col("weight") * F.col("level.rest") / F.col("level.sharing"))
        .alias("target"),
    )


def _crossing(rows, open_budgets, shift):
    """Of each source the bucket in which the running sum of words reaches its budget.

    `rows` has source, size, point; `open_budgets` has source, rest and before (words of
    that source below these rows).
    """
    histogram = (
        rows.groupBy("source", F.shiftright("point", shift).alias("bucket"))
        .agg(F.sum("size").alias("n"), F.min("point").alias("low"), F.max("point").alias("high"))
        .withColumnRenamed("source", "of")
    )
    running = F.sum("n").over(Window.partitionBy("source").orderBy("bucket"))
    return (
        histogram.join(open_budgets, F.col("of").eqNullSafe(F.col("source")))
        .withColumn("upto", F.col("before") + running)
        .where("upto >= rest")
        .groupBy("source")
        .agg(F.min_by(F.struct("rest", "bucket", "n", "low", "high", "upto"), "bucket").alias("c"))
        .select("source", "c.*", (F.col("c.upto") - F.col("c.n")).alias("before"))
    )


def thresholds(sizes, targets):
    """source, source_size, target, whole and bound of every source.

    A source gives `whole` copies of each document, and one more of those whose point is
    below `bound`. The bound lies where the words come nearest to the target; of two
    equally near ones the lower. Documents of one id share a point and go together.
    """
    plan = stored(
        targets.select(
            "source",
            "source_size",
            "target",
            F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
            .otherwise(F.lit(0))
            .cast("int")
            .alias("whole"),
        ).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")),
        "mix-plan",
    )
    rows = sizes.select("source", "size", "point")
    budgets = plan.where("rest > 0").select("source", "rest", F.lit(0).cast("long").alias("before"))
    found = None
    for shift in range(POINT_BITS - BUCKET_BITS, -1, -BUCKET_BITS):
        crossing = stored(_crossing(rows, budgets, shift), "mix-crossing")
        settled = crossing.where("low = high")
        found = settled if found is None else found.union(settled)
        edges = crossing.where("low < high")
        if shift == 0 or edges.isEmpty():
            break
        # Only the documents of the boundary buckets are counted again.
        edge = edges.select(F.col("source").alias("of"), "bucket")
        budgets = edges.select("source", "rest", "before")
        rows = stored(
            rows.join(
                edge,
                F.col("source").eqNullSafe(F.col("of"))
                & (F.shiftright("point", shift) == F.col("bucket")),
            ).select("source", "size", "point"),
            "mix-boundary",
        )
    nearest = found.select(
        F.col("source").alias("of"),
        F.when(F.col("upto") - F.col("rest") < F.col("rest") - F.col("before"), F.col("low") + 1)
        .otherwise(F.col("low"))
        .alias("bound"),
    )
    return stored(
        plan.join(nearest, F.col("source").eqNullSafe(F.col("of")), "left").select(
            "source", "source_size", "target", "whole", F.coalesce("bound", F.lit(0)).alias("bound")
        ),
        "mix-thresholds",
    )


def _copies():
    return F.col("whole") + F.when(F.col("point") < F.col("bound"), 1).otherwise(0)


def mix(docs, weights=(3, 1, 2), share=1.5, most=2):
    """doc_id, size, source_size, target, copies and taken (size x copies) per row of `docs`.

    Null and empty texts have size 0 and are taken 0 words; a null source is a source of
    its own; an empty table gives no rows. The same ids give the same mix on every run.
    The join has one row per source on its small side; where that is too large to be
    broadcast, the adaptive plan splits a hot source.
    """
    sizes = stored(sized(docs), "mix-sizes")
    bounds = thresholds(sizes, source_targets(sizes, weights, share, most))
    joined = sizes.join(
        bounds.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))
    )
    return joined.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        _copies().cast("int").alias("copies"),
        (F.col("size") * _copies()).cast("long").alias("taken"),
    )


def mixed(docs, weights=(3, 1, 2), share=1.5, most=2):
    """The mix itself: rows of `docs`, all columns, each as often as the mix takes it."""
    sizes = stored(sized(docs), "mix-sizes")
    bounds = thresholds(sizes, source_targets(sizes, weights, share, most))
    return (
        docs.select(F.struct("*").alias("row"), F.col("source").alias("own"), point().alias("point"))
        .join(bounds, F.col("own").eqNullSafe(F.col("source")))
        .select("row", F.explode(F.array_repeat(F.lit(0), _copies().cast("int"))))
        .select("row.*")
    )
