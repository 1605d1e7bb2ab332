"""Equi-joins that split hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Every key with more rows on a side is hot, and so is one whose rows make more pairs. So n rows have fewer than
# n / ROWS_PER_SLICE + n / sqrt(PAIRS_PER_SLICE) hot keys, which is why their table is broadcast.
ROWS_PER_SLICE = 200_000
PAIRS_PER_SLICE = 400_000_000


def hot_keys(counts: DataFrame, on: list[str], rows_per_slice: int, slices: str, count: str = "count") -> DataFrame:
    """All keys with more than ``rows_per_slice`` rows, and the number of slices each is split into."""
    n = F.ceil(F.col(count) / rows_per_slice).cast("int")
    return counts.where(F.col(count) > rows_per_slice).select(*on, n.alias(slices))


def hot_pairs(left: DataFrame, right: DataFrame, on: list[str], rows_per_slice: int, pairs_per_slice: int) -> DataFrame:
    """Keys (with ``_ln``, ``_rn``: slices of their sides) that have too many rows on a side or too many pairs for a task.

    Keys of one side only are in no pair and left out.
    """
    counted = left.groupBy(*on).agg(F.count("*").alias("_l")).join(right.groupBy(*on).agg(F.count("*").alias("_r")), on)
    return hot_counted(counted, on, rows_per_slice, pairs_per_slice)


def hot_counted(counted: DataFrame, on: list[str], rows_per_slice: int, pairs_per_slice: int) -> DataFrame:
    """``hot_pairs`` of keys whose rows (``_l``, ``_r``) are counted already.

    The side with fewer rows is cut as little as can be, the other one into slices that then make
    ``pairs_per_slice`` pairs at most.
    """
    few, many = F.least("_l", "_r"), F.greatest("_l", "_r")
    short = F.least(few, F.lit(rows_per_slice), F.ceil(F.sqrt(F.lit(float(pairs_per_slice)))))
    long = F.greatest(F.lit(1), F.least(F.lit(rows_per_slice), F.floor(F.lit(pairs_per_slice) / short)))
    cut_few, cut_many = F.ceil(few / short).cast("int"), F.ceil(many / long).cast("int")
    cut = counted.select(*on, F.when(F.col("_l") <= F.col("_r"), cut_few).otherwise(cut_many).alias("_ln"), F.when(F.col("_l") <= F.col("_r"), cut_many).otherwise(cut_few).alias("_rn"))
    return cut.where("_ln > 1 OR _rn > 1")


def split_hot_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    left_id: list[str],
    right_id: list[str],
    rows_per_slice: int = ROWS_PER_SLICE,
    left_hot: DataFrame | None = None,
    right_hot: DataFrame | None = None,
    pairs_per_slice: int = PAIRS_PER_SLICE,
    tasks: int | None = None,
) -> DataFrame:
    """Inner join on ``on`` in which a hot key is cut into slices on either side.

    A slice of one side meets every slice of the other exactly once, so the result is the
    plain inner join.  Keys that are not hot have one slice and are not copied.  Pass
    ``left_hot`` or ``right_hot`` (keys, ``_ln`` or ``_rn``) when key counts are known already;
    without both, keys are counted, and cut by the number of their pairs.  Rows are dealt to ``tasks`` if
    given, where they make far more pairs than their bytes tell.
    """
    if left_hot is None and right_hot is None:
        hot = hot_pairs(left, right, on, rows_per_slice, pairs_per_slice)
    else:
        left_hot = hot_keys(left.groupBy(*on).count(), on, rows_per_slice, "_ln") if left_hot is None else left_hot
        right_hot = hot_keys(right.groupBy(*on).count(), on, rows_per_slice, "_rn") if right_hot is None else right_hot
        hot = left_hot.join(right_hot, on, "full")

    def with_slices(df: DataFrame) -> DataFrame:
        return df.join(F.broadcast(hot), on, "left").withColumns(
            {"_ln": F.coalesce("_ln", F.lit(1)), "_rn": F.coalesce("_rn", F.lit(1))}
        )

    def own(ids: list[str], n: str) -> Column:
        return F.pmod(F.xxhash64(*ids), F.col(n)).cast("int")

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    l = with_slices(left).withColumn("_a", own(left_id, "_ln")).withColumn("_b", every("_rn")).drop("_ln", "_rn")
    r = with_slices(right).withColumn("_b", own(right_id, "_rn")).withColumn("_a", every("_ln")).drop("_ln", "_rn")
    if tasks is not None:
        l, r = l.repartition(tasks, *on, "_a", "_b"), r.repartition(tasks, *on, "_a", "_b")
    return l.join(r, [*on, "_a", "_b"]).drop("_a", "_b")


def split_hot_lookup(
    left: DataFrame, right: DataFrame, on: list[str], left_id: list[str], left_hot: DataFrame, how: str = "left"
) -> DataFrame:
    """Join to a table with one row per key, with hot keys of ``left`` cut into slices.

    Only the rows looked up are copied, once per slice of their key.
    """
    hot = F.broadcast(left_hot)
    l = left.join(hot, on, "left").withColumn("_a", F.pmod(F.xxhash64(*left_id), F.coalesce("_ln", F.lit(1))).cast("int"))
    r = right.join(hot, on, "left").withColumn("_a", F.explode(F.sequence(F.lit(0), F.coalesce("_ln", F.lit(1)) - 1)))
    return l.drop("_ln").join(r.drop("_ln"), [*on, "_a"], how).drop("_a")
