"""Where intermediate tables go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_root(spark: SparkSession) -> str:
    """The shared folder the session names in ``spark.checkpoint.dir``.

    A local session without the setting uses a temporary folder; on a cluster that
    would be a different folder on every machine, so there it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if spark.sparkContext.master.startswith("local"):
        return tempfile.gettempdir()
    raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    return f"{shared_root(spark).rstrip('/')}/ticketlens/{name}-{uuid.uuid4().hex}"
