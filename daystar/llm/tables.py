"""Written tables between steps, and small helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import functions as F

from daystar.sources.scratch import new_folder

LAST_ID = (1 << 63) - 1
# Word of the contracts: a run of anything but ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"


def stored(df, label):
    """Write `df` below the shared folder and read it back.

    Cuts the lineage: later steps read files that every executor sees, so a lost
    executor costs the tasks it was running, not the steps before.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def told_apart(docs):
    """key, tie and row (all columns) of `docs`; no two rows share both key and tie.

    key is doc_id, a null one counts as the greatest. tie is 0 where the key is one row's
    alone. Rows that share a key are written once and numbered, by the hash of their text,
    null ids after others: which of them is earlier depends on nothing but their texts.
    """
    keyed = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("key"), F.struct("*").alias("row")
    )
    shared = stored(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "shared-ids")
    alone = keyed.select("key", F.lit(0).cast("long").alias("tie"), "row")
    if not shared.take(1):
        return alone
    # The last of the columns splits a large group of equal rows over tasks.
    ordered = keyed.join(shared, "key", "left_semi").orderBy(
        "key", F.col("row.doc_id").isNull(), F.xxhash64("row.text"), F.monotonically_increasing_id()
    )
    several = stored(
        ordered.select("key", (F.monotonically_increasing_id() + 1).alias("tie"), "row"), "told-apart"
    )
    return alone.join(shared, "key", "left_anti").union(several)


def text_or_empty(text="text"):
    return F.coalesce(F.col(text), F.lit(""))


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
