"""Best-fit packing of token pieces into sequences of a fixed capacity.

Items over a third of the capacity go at most two to a sequence: the largest is matched with
the largest that fits beside it. Smaller ones fill the remaining gaps, largest first, each the
tightest gap that holds it. All items of one length are alike, so the plan is made from the
number of items of each length: that histogram has at most ``capacity`` rows, whatever the
corpus. The plan is a list of runs (items of a length with consecutive ranks, in consecutive
sequences). An item finds its sequence by its length and its rank among items of that length.

Bound of the plan: a run either ends a length (at most ``capacity`` times, and then leaves two
more intervals of sequences) or uses up an interval whose gap it at least halves. So there are
at most about ``3 * capacity * log2(capacity)`` runs.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placeweave.llm.common import importable, written
from placeweave.llm.tokens import encoded

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Ranks are counted in groups of about so many rows, or the root of a length's number if that is more.
RANK_ROWS = 500

Run = tuple[int, int, int, int, int, int]  # length, first rank, items, first sequence, items in each sequence, offset


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: all full, but for the first."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)] if n else []


def pieces(docs: DataFrame, vocabulary: str, end_id: int, capacity: int, ranks: str | None = None) -> DataFrame:
    """PIECES of every row's ids and ``end_id``; null texts are empty, so one piece of one id."""
    end = np.array([end_id], "<u4").tobytes()

    def per_row(doc_id, ids):
        ids = memoryview(ids + end)
        return [(doc_id, k, s, n, zlib.crc32(ids[4 * s : 4 * (s + n)])) for k, (s, n) in enumerate(cut(len(ids) // 4, capacity))]

    return encoded(docs, vocabulary, ranks, per_row, PIECES)


def plan(items: dict[int, int], capacity: int) -> list[Run]:
    """Where the items of each length go. ``items``: how many there are, by length."""
    left = {n: c for n, c in items.items() if c > 0}
    if left and not 0 < min(left) <= max(left) <= capacity:
        raise ValueError("lengths must be between 1 and the capacity")
    runs: list[Run] = []
    rank = dict.fromkeys(left, 0)
    gaps: dict[int, list[tuple[int, int]]] = {}  # by gap: (first sequence, sequences)
    sequences = 0

    def place(length: int, count: int, first: int, each: int, offset: int) -> None:
        runs.append((length, rank[length], count, first, each, offset))
        rank[length] += count
        left[length] -= count

    def leave(gap: int, first: int, count: int) -> None:
        if gap and count:
            gaps.setdefault(gap, []).append((first, count))

    large = sorted(n for n in left if 3 * n > capacity)
    for x in reversed(large):
        while left[x]:
            k = bisect_left(large, min(x, capacity - x) + 1) - 1
            while k >= 0 and (not left[large[k]] or large[k] == x and left[x] < 2):
                k -= 1
            if k < 0:
                pairs, y = left[x], 0
                place(x, pairs, sequences, 1, 0)
            elif large[k] == x:
                pairs, y = left[x] // 2, x
                place(x, 2 * pairs, sequences, 2, 0)
            else:
                y = large[k]
                pairs = min(left[x], left[y])
                place(x, pairs, sequences, 1, 0)
                place(y, pairs, sequences, 1, x)
            leave(capacity - x - y, sequences, pairs)
            sequences += pairs

    for x in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[x]:
            gap = min((g for g in gaps if g >= x), default=0)
            if not gap:
                gap, count = capacity, -(-left[x] // (capacity // x))
                leave(gap, sequences, count)
                sequences += count
            first, count = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap]
            each = min(gap // x, left[x])
            used = min(count, left[x] // each)
            place(x, used * each, first, each, capacity - gap)
            leave(gap - each * x, first, used)
            leave(gap, first + used, count - used)
    return runs


def ranked(items: DataFrame, histogram: dict[int, int]) -> DataFrame:
    """Adds ``rank``: 0, 1, ... among the rows of each length, by groups none of which is large."""
    spark = items.sparkSession
    groups = spark.createDataFrame([(n, math.ceil(c / max(RANK_ROWS, math.isqrt(c)))) for n, c in histogram.items()] or [(0, 1)], "length long, n_groups long")
    # at most one row for each length, so at most as many as the capacity
    dealt = items.join(F.broadcast(groups), "length").withColumn("group", F.pmod(F.xxhash64("doc_id", "piece"), "n_groups")).drop("n_groups")
    before = Window.partitionBy("length").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    base = dealt.groupBy("length", "group").count().select("length", "group", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "group").orderBy("doc_id", "piece", "start")
    return dealt.join(base, ["length", "group"]).withColumn("rank", F.col("base") + F.row_number().over(inside) - 1).drop("base", "group")


def pack(items: DataFrame, capacity: int) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to a table with PIECES' columns.

    Pieces of one sequence stand without gaps from 0. Repeated rows are items of their own; ties
    of a length are ordered by doc_id and piece; an empty table gives an empty one. ``items`` is
    read more than once: write it down first if it is expensive.
    """
    importable(items.sparkSession)
    histogram = {r["length"]: r["count"] for r in items.groupBy("length").count().collect()}  # at most `capacity` rows
    runs = items.sparkSession.sparkContext.broadcast(np.array(sorted(plan(histogram, capacity)) or np.zeros((0, 6)), np.int64))
    columns = [c for c in items.columns]
    out = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in items.schema) + ", sequence_id long, offset long"

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, first_rank, _, first, each, offset = runs.value.T
        order = length * (1 << 44) + first_rank
        for batch in batches:
            n, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            k = np.searchsorted(order, n * (1 << 44) + rank, side="right") - 1
            within = rank - first_rank[k]
            added = [pa.array(first[k] + within // each[k]), pa.array(offset[k] + within % each[k] * n)]
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(c)) for c in columns] + added, names=[*columns, "sequence_id", "offset"])

    return ranked(items, histogram).select(*columns, "rank").mapInArrow(place, out)


def pack_documents(docs: DataFrame, vocabulary: str, ranks: str | None = None, end_id: int = 2, capacity: int = 1024) -> DataFrame:
    return pack(written(pieces(docs, vocabulary, end_id, capacity, ranks), "pieces"), capacity)
