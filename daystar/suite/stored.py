"""Silver and gold tables of the derived feeds, written once per session.

Dimensions and facts are queried from stored silver, marts from stored gold, as
the jobs hand over: each stage reads what the one before has written.
"""

from __future__ import annotations

from daystar.plans import pipeline
from daystar.sources import files, scratch
from daystar.suite import fixtures as fx

# Folder of the stored tables by application and input folder.
_BASES = {}


def write_bronze(spark, sf_dir, base):
    files.write_csv(fx.cases(spark, sf_dir), f"{base}/bronze/cases")
    files.write_csv(fx.tests(spark, sf_dir), f"{base}/bronze/tests")
    files.write_csv(fx.lookup(spark, sf_dir), f"{base}/bronze/static")


def base(spark, sf_dir):
    """Folder of the stored star of these tables."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BASES:
        folder = scratch.new_folder(spark, "star")
        write_bronze(spark, sf_dir, folder)
        pipeline.build_silver(spark, folder, ["state_code"])
        pipeline.build_gold(spark, folder)
        _BASES[key] = folder
    return _BASES[key]


def silver(spark, sf_dir, name):
    return pipeline.silver_tables(spark, base(spark, sf_dir))[name]


def gold(spark, sf_dir, name):
    return pipeline.gold_tables(spark, base(spark, sf_dir))[name]
