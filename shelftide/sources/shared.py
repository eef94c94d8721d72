"""Where intermediate tables go.

A cluster names a folder that all executors can reach in ``spark.checkpoint.dir``. Only a
local session without that setting gets a temporary folder, since driver and executors
are then the same machine.
"""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, else the one that the context checkpoints to. If
    the context has none, checkpoints go to this folder from here on; settings stay as they are."""
    context = spark.sparkContext
    set_before = context.getCheckpointDir()
    folder = spark.conf.get("spark.checkpoint.dir", None) or set_before
    if not folder:
        if not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        folder = tempfile.mkdtemp(prefix="shelftide-")
        # The folder goes with the session that needed it.
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    if set_before is None:
        context.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, so that runs never overwrite each other."""
    return f"{shared_folder(spark).rstrip('/')}/shelftide-{uuid.uuid4().hex}/{name}"
