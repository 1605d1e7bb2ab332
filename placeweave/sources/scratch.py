"""Folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


@cache
def _own_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="placeweave-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, only a session that runs in one process (as in tests) gets a temporary
    folder; on a cluster, where executors could not see it, that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = _own_folder(spark.sparkContext.applicationId)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
