"""Session settings the jobs are tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Partitions that a shuffle starts with, for a cluster; see `build_session`.
INITIAL_PARTITIONS = 8000

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Rows and sizes that the catalog knows of registered tables decide what is broadcast.
    "spark.sql.cbo.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Merged partitions get about this much; a task's memory is a multiple of it.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def build_session(app="daystar", master=None, settings=None, partitions=INITIAL_PARTITIONS):
    """Build a session; on a cluster leave `master` to spark-submit.

    A shuffle starts with `partitions` and adaptive execution merges the small ones; it
    never makes more of them, so the number has to suit the largest shuffle: 100 TB in
    8,000 are 12.5 GB each before skew handling, which spills but runs. More partitions
    cost bookkeeping (map tasks x partitions). One machine needs about its cores.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    started = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions)}
    for key, value in {**SETTINGS, **started, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
