"""Comparing the members of groups without meeting a large group in one task.

Members of a group with more than ``size`` rows are dealt to chunks by a hash; every two chunks
of a group make a block, and so does each chunk alone. A task sees one block at a time. Within
its block it compares rows of different chunks only, or those of one chunk, so every two members
of a group meet in exactly one block.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dealt(rows: DataFrame, key: str, member: str, size: int) -> DataFrame:
    """Rows of groups with two members or more, with ``chunk``, ``low`` and ``high`` (the block's chunks).

    Rows of groups of up to ``size`` come once; of larger ones, once for each chunk of the group.
    """
    counts = rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").select(key, F.ceil(F.col("n") / size).cast("int").alias("chunks"))
    found = rows.join(counts, key).withColumn("chunk", F.pmod(F.xxhash64(member), "chunks").cast("int"))
    found = found.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return found.withColumn("low", F.least("chunk", "other")).withColumn("high", F.greatest("chunk", "other")).drop("chunks", "other")


def together(blocks: DataFrame, key: str) -> DataFrame:
    return blocks.repartition(key, "low", "high").sortWithinPartitions(key, "low", "high")


def runs(batches: Iterable[pa.RecordBatch], *keys: str) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole runs of equal keys with the places where one begins, and the end; holds back the last run of a batch."""
    held: list[pa.RecordBatch] = []

    def starts(t: pa.Table) -> np.ndarray:
        new = np.zeros(t.num_rows, bool)
        new[:1] = True
        for k in (t.column(c).to_numpy() for c in keys):
            new[1:] |= k[1:] != k[:-1]
        return np.flatnonzero(new)

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        table = pa.Table.from_batches(held)
        at = starts(table)
        if len(at) > 1:
            yield table.slice(0, int(at[-1])), at
            held = table.slice(int(at[-1])).to_batches()
    if held:
        table = pa.Table.from_batches(held)
        yield table, np.append(starts(table), table.num_rows)
