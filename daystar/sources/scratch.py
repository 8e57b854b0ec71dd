"""Space for tables that a job writes and reads again."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

_SETTING = "spark.checkpoint.dir"
_ONE_MACHINE = re.compile(r"local(\[.*\])?")

# Temporary folders made here, by application; they go when this process ends.
_OWN = {}


def shared_folder(spark):
    """The folder that the cluster names for such data; all executors must see it.

    That is `spark.checkpoint.dir`, or else the folder given to `setCheckpointDir`. Only a
    session on one machine may leave both unset, as tests do: it gets one temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get(_SETTING, None) or context.getCheckpointDir()
    if folder is None:
        if not _ONE_MACHINE.fullmatch(context.master):
            raise RuntimeError(f"set {_SETTING} to a folder that all executors share")
        folder = _own_folder(context.applicationId)
    return folder.rstrip("/")


def new_folder(spark, label):
    """A path of its own below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _own_folder(application):
    if application not in _OWN:
        _OWN[application] = tempfile.mkdtemp(prefix="daystar-")
        atexit.register(shutil.rmtree, _OWN[application], ignore_errors=True)
    return _OWN[application]
