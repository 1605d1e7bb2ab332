"""Numbers by order, for tables and groups of any size.

Rows are sorted over all tasks at once; a row's number is its place in its task plus the rows of the
tasks before, so no group, and never the whole table, passes through one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placeweave.sources.scratch import scratch_path

_PART, _AT = 33, (1 << 33) - 1  # bits of a generated id: its task, and the row's place in it


def _placed(df: DataFrame, order: list[Column | str]) -> DataFrame:
    """df sorted, as a written table with ``_part`` (ascending with the order) and ``_at`` (from 0)."""
    path = scratch_path(df.sparkSession, "ordered")
    place = F.monotonically_increasing_id()
    df.orderBy(*order).select("*", F.shiftright(place, _PART).alias("_part"), place.bitwiseAND(F.lit(_AT)).alias("_at")).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def numbered(df: DataFrame, order: list[Column | str], name: str) -> DataFrame:
    """df with ``name``: 0, 1, 2, ... in the given order, without gaps."""
    placed = _placed(df, order)
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))  # a row for each task
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(_earlier()), F.lit(0)).alias("_before"))
    return placed.join(F.broadcast(before), "_part").withColumn(name, F.col("_at") + F.col("_before")).drop("_part", "_at", "_before")


def ranked(df: DataFrame, group: str, order: list[Column | str], name: str) -> DataFrame:
    """df with ``name``: 1, 2, 3, ... within each value of ``group``, in the given order."""
    placed = _placed(df, [group, *order])
    # A group lies in neighbouring tasks; what it has in one of them is one row here.
    runs = placed.groupBy(group, "_part").agg(F.min("_at").alias("_start"), F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(_earlier(group)), F.lit(0))
    shift = runs.select(group, "_part", (before - F.col("_start") + 1).alias("_shift"))
    same = [F.col(f"p.{group}").eqNullSafe(F.col(f"s.{group}")), F.col("p._part") == F.col("s._part")]
    found = placed.alias("p").join(shift.alias("s"), same[0] & same[1])
    return found.select(*[F.col(f"p.`{c}`") for c in df.columns], (F.col("p._at") + F.col("s._shift")).alias(name))


def _earlier(*group: str):
    return Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
