"""Reading and writing record files."""

from __future__ import annotations

import os
import re
import shutil
import uuid
from urllib.parse import unquote, urlsplit

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CORRUPT = "_corrupt_record"
#: Folder of rows without a value, and characters that names of folders don't have, as Spark writes them.
NO_VALUE, ESCAPED = "__HIVE_DEFAULT_PARTITION__", re.compile("[\x01-\x1f\"#%'*/:=?\\\\\x7f{\\[\\]^]")


def _parsed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Lines with the record each holds.  Parsing lines, not files, lets a plan ask for the bad ones alone."""
    record = F.from_json("value", f"{schema}, {CORRUPT} string", {"columnNameOfCorruptRecord": CORRUPT})
    return spark.read.text(path).where(F.trim("value") != "").select("value", record.alias("record"))


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records of JSON lines; a line that is no such record keeps its text in ``_corrupt_record``."""
    return _parsed(spark, path, schema).select("record.*")


def good_records(df: DataFrame) -> DataFrame:
    return df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def bad_records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The lines that are no such records, as they stand, for a quarantine table."""
    return _parsed(spark, path, schema).where(F.col(f"record.{CORRUPT}").isNotNull()).select("value")


def read_optional_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """Like ``read_jsonl``, but None when there is nothing at ``path``; other errors are raised."""
    try:
        return read_jsonl(spark, path, schema)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def write_jsonl(df: DataFrame, path: str) -> None:
    """JSON lines in UTF-8 with null keys kept, written by the executors."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_sample(df: DataFrame, path: str, order: list[str], n: int = 2000) -> None:
    """The first ``n`` rows in the given order."""
    write_jsonl(first_rows(df, order, n), path)


def first_rows(df: DataFrame, order: list[str], n: int = 2000) -> DataFrame:
    return df.orderBy(*order).limit(n)


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Ordered place phrases (pos, phrase) of a JSON array; no file gives no phrases."""
    try:
        lines = spark.read.text(path, wholetext=True)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "pos int, phrase string")
    return lines.select(F.posexplode(F.from_json("value", "array<string>")).alias("pos", "phrase"))


def _local_path(spark: SparkSession, path: str) -> str | None:
    """The path in the file system of the machine (or one mounted there), None if it is elsewhere."""
    parts = urlsplit(path)
    if parts.scheme == "file":
        return unquote(parts.path)
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    return path if "://" not in path and default.startswith("file:") else None


def write_text_files(df: DataFrame, folder: str, path: str) -> None:
    """Texts (value) as files in a folder for each value of ``folder``.

    A file costs the same however short it is, so rows are dealt over all cores, not by their bytes. In a local
    file system tasks write the files themselves: Hadoop would start processes to set the mode of each.
    """
    spark = df.sparkSession
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    root = _local_path(spark, path)
    if root is None:
        df.repartition(tasks, folder).write.partitionBy(folder).text(path)
    else:
        _write_local_files(df, folder, root, tasks)


def _write_local_files(df: DataFrame, folder: str, root: str, tasks: int) -> None:
    """What Spark would write, one file in a folder; all of it appears at once when the last one is there."""
    if os.path.exists(root):
        raise FileExistsError(root)
    base = f"{root.rstrip('/')}.{uuid.uuid4().hex}"
    job = uuid.uuid4()

    def escaped(name):
        return ESCAPED.sub(lambda c: f"%{ord(c[0]):02X}", name)

    def work(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}-{job}.txt"
        own = f".{name}.{task.taskAttemptId()}"  # a file has its name only when it is whole
        last, current, out, done = None, None, None, 0

        def close():
            out.close()
            os.replace(f"{current}/{own}", f"{current}/{name}")

        for batch in batches:
            for at, value in zip(batch.column("at").to_pylist(), batch.column("value").to_pylist()):
                if at != last:
                    if out is not None:
                        close()
                    last, current, done = at, f"{base}/{escaped(folder)}={escaped(at)}", done + 1
                    os.makedirs(current, exist_ok=True)
                    out = open(f"{current}/{own}", "wb")
                out.write((value or b"") + b"\n")
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([done], pa.int64())], names=["files"])

    value = F.col(folder).cast("string")
    rows = df.select(F.when(value != "", value).otherwise(NO_VALUE).alias("at"), F.col("value").cast("binary"))
    try:
        os.makedirs(base)
        rows.repartition(tasks, "at").sortWithinPartitions("at").mapInArrow(work, "files long").agg(F.sum("files")).collect()
        open(f"{base}/_SUCCESS", "w").close()
        os.rename(base, root)
    except BaseException:
        shutil.rmtree(base, ignore_errors=True)
        raise


LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def read_html_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per HTML file: where it lies and its text.

    Folders are looked into by some tasks a core; by itself Spark starts one for each folder, up to 10,000, which takes longer than looking.
    """
    before = spark.conf.get(LISTING)
    spark.conf.set(LISTING, str(min(int(before), 8 * spark.sparkContext.defaultParallelism)))
    try:
        lines = spark.read.text(path, wholetext=True)
    finally:
        spark.conf.set(LISTING, before)
    return lines.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("html"))


def city_from_path(path: Column) -> Column:
    """City of a saved page or record file: the name of the folder it lies in."""
    return F.element_at(F.split(path, "/"), -2)
