"""Parquet folders that are replaced without a moment in which they hold nothing.

Every full write goes to a folder of its own below the table's, `version=<number>`. Spark's committer
puts `_SUCCESS` there last of all, and readers take the newest folder that has it: a job that
dies while it writes leaves the rows of before in force. Folders of before stay
until later writes, so queries that are still reading them end undisturbed.
"""

from __future__ import annotations

import re
import uuid

_FOLDER = re.compile(r"version=(\d{8})-[0-9a-f]{8}")


def children(spark, path):
    """Names of what lies directly in a folder, of any store that Spark reads; none if it is not there."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not store.exists(folder):
        return []
    return sorted(status.getPath().getName() for status in store.listStatus(folder))


def versions(spark, path):
    """Complete versions of a table folder, oldest first, as (number, folder)."""
    found = []
    for name in children(spark, path):
        match = _FOLDER.fullmatch(name)
        if match and "_SUCCESS" in children(spark, f"{path}/{name}"):
            found.append((int(match[1]), f"{path}/{name}"))
    return sorted(found)


def current(spark, path):
    """The folder that holds the rows of a table: its newest complete version, or the folder itself."""
    found = versions(spark, path)
    return found[-1][1] if found else path


def new_version(spark, path):
    """Folder that the next full write of a table goes to.

    Of two writers at once both finish; the later number, then the name, is read.
    """
    numbers = [int(m[1]) for m in map(_FOLDER.fullmatch, children(spark, path)) if m]
    return f"{path}/version={max(numbers, default=0) + 1:08d}-{uuid.uuid4().hex[:8]}"


def drop_old(spark, path, keep=2):
    """Remove complete versions but the newest `keep`. Unfinished ones may be another writer's and stay."""
    jvm = spark.sparkContext._jvm
    for _, folder in versions(spark, path)[:-keep]:
        old = jvm.org.apache.hadoop.fs.Path(folder)
        old.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(old, True)
