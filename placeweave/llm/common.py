"""What the operators of this subpackage share: the shared folder, written tables, column picking."""

from __future__ import annotations

import os
import tempfile
import uuid
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@cache
def _own_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="llm-")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which driver and executors share.

    Where it is unset, only a session that runs in one process gets a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return "file://" + _own_folder(spark.sparkContext.applicationId)


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: cuts lineage, and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def importable(spark: SparkSession) -> None:
    """Lets Python workers on this machine import the package; a cluster ships it with --py-files."""
    sc = spark.sparkContext
    if sc.master.startswith("local"):
        paths = [ROOT, *filter(None, (sc.environment.get("PYTHONPATH") or "").split(os.pathsep))]
        sc.environment["PYTHONPATH"] = os.pathsep.join(dict.fromkeys(paths))


def text_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", more: list[str] | None = None) -> DataFrame:
    """Key and text (and ``more``) alone, null texts as empty ones; columns with other names can't clash."""
    return docs.select(F.col(key).cast("long").alias(key), F.coalesce(F.col(text), F.lit("")).alias(text), *(more or []))


def null_safe_key(c: Column | str) -> Column:
    """A long to hash by, for keys that may be null."""
    return F.xxhash64(F.col(c) if isinstance(c, str) else c)


_stores: dict[str, dict] = {}


def worker_store(name: str) -> dict:
    """A dict that lives as long as the Python worker; those of other operators are emptied, so that a worker holds one's caches only."""
    for other, store in _stores.items():
        if other != name:
            store.clear()
    return _stores.setdefault(name, {})
