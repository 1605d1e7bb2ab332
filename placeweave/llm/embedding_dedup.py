"""Near-duplicate vectors: random-hyperplane sign hashing, exact cosines, connected components.

Equal vectors are one class. A class is hashed once for each table, by the signs of its products
with random hyperplanes; classes with the same hash in a table are compared by cosine in double
precision. Planes grow with the logarithm of the number of classes, so that a bucket of vectors
without likeness keeps its size and the pairs compared grow with the table, not with its square; and
tables grow with the planes, so that a pair at the threshold is found with the same probability.
Two vectors of cosine 0.9 agree in a sign with probability 0.856, so with 12 planes they meet in one
of 32 tables with probability 1 - (1 - 0.856 ** 12) ** 32 = 0.995, and those of 0.95 with 0.99997.
Vectors go only to buckets that hold two classes or more. A pair that meets in several tables is
counted in the first. Blocks yield counts and a spanning forest of their links, never all pairs, and
large buckets are compared by chunks.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeweave.llm import blocks
from placeweave.llm.common import importable, written
from placeweave.llm.components import components

#: Planes at least, classes of a bucket for each of which there is a plane more, and the recall at the threshold.
PLANES, BUCKET, RECALL, SEED = 12, 64, 0.995, 20
#: Rows of a chunk of a large bucket, and pairs looked at together for whether they met before.
CHUNK_ROWS, PAIRS_AT_ONCE = 500, 100_000


def layout(classes: int, threshold: float = 0.9) -> tuple[int, int]:
    """(tables, planes) for so many classes: buckets of ``BUCKET`` by chance, and ``RECALL`` at the threshold."""
    planes = min(31, max(PLANES, math.ceil(math.log2(max(classes, 1) / BUCKET))))
    agree = 1 - math.acos(threshold) / math.pi
    return math.ceil(math.log(1 - RECALL) / math.log1p(-(agree**planes))), planes


def units(flat: np.ndarray, dims: int) -> np.ndarray:
    """Vectors of length one; scaled first, so that squares neither overflow nor vanish."""
    x = flat.astype(np.float64).reshape(-1, dims)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def hashes(x: np.ndarray, tables: int, planes: int) -> np.ndarray:
    """(rows, tables): what the signs of a table's products make, as a number."""
    normals = np.random.default_rng((SEED, x.shape[1])).standard_normal((x.shape[1], tables * planes))
    return ((x @ normals > 0).reshape(len(x), tables, planes) @ (1 << np.arange(planes))).astype(np.int32)


def hashed(classes: DataFrame, tables: int, planes: int) -> DataFrame:
    kind = classes.schema["embedding"].dataType.simpleString()

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(3)
            size = pa.compute.list_value_length(vectors).to_numpy(zero_copy_only=False)
            found = np.zeros((len(size), tables), np.int32)
            for d in np.unique(size).tolist():
                at = np.flatnonzero(size == d)
                flat = vectors.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
                found[at] = hashes(units(flat, d), tables, planes)
            signs = pa.ListArray.from_arrays(pa.array(np.arange(0, found.size + 1, tables), pa.int32()), pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, signs], names=["node", "first", "copies", "embedding", "signs"])

    return classes.select("node", "first", "copies", "embedding").mapInArrow(work, f"node long, first long, copies long, embedding {kind}, signs array<int>")


def _met_before(signs: np.ndarray, i: np.ndarray, j: np.ndarray, table: int) -> np.ndarray:
    before = np.zeros(len(i), bool)
    for a in range(0, len(i), PAIRS_AT_ONCE):
        p = slice(a, a + PAIRS_AT_ONCE)
        before[p] = (signs[i[p], :table] == signs[j[p], :table]).any(axis=1)
    return before


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    found, left = [], np.flatnonzero(linked.any(axis=1))
    while len(left):
        root, left = left[0], left[1:]
        queue = [root]
        while queue and len(left):
            hit = linked[queue.pop(), left]
            new, left = left[hit].tolist(), left[~hit]
            found += [(root, q) for q in new]
            queue += new
    return found


def links(found: DataFrame, threshold: float, tables: int, planes: int) -> DataFrame:
    """Rows (a, null, n): class a is linked to n vectors of other classes, to be summed; and (a, b, 0): a and b are connected."""
    table = F.posexplode("signs").alias("table", "hash")
    rows = found.select("node", F.size("embedding").alias("dims"), table)
    rows = rows.select("node", F.shiftleft((F.col("dims").cast("long") * tables + F.col("table")), planes).bitwiseOR(F.col("hash").cast("long")).alias("key"))
    met = blocks.dealt(rows, "key", "node", CHUNK_ROWS).join(found.select("node", "copies", "embedding", "signs"), "node")

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, at in blocks.runs(batches, "key", "low", "high"):
            node, copies, chunk, low, high, key = (t.column(c).to_numpy() for c in ("node", "copies", "chunk", "low", "high", "key"))
            vectors, signs = (t.column(c).combine_chunks() for c in ("embedding", "signs"))
            size = pa.compute.list_value_length(vectors).to_numpy()
            ends = np.concatenate([[0], np.cumsum(size)])
            flat, signs = vectors.flatten().to_numpy(), signs.flatten().to_numpy().reshape(-1, tables)
            a_, b_, n_ = [], [], []
            for p, q in zip(at[:-1].tolist(), at[1:].tolist()):
                if q - p < 2:
                    continue
                x = units(flat[ends[p] : ends[q]], int(size[p]))
                linked = x @ x.T >= threshold
                np.fill_diagonal(linked, False)
                if low[p] != high[p]:
                    linked &= chunk[p:q, None] != chunk[None, p:q]
                if not linked.any():
                    continue
                i, j = np.nonzero(np.triu(linked))
                new = ~_met_before(signs[p:q], i, j, int(key[p] >> planes) % tables)
                i, j = i[new], j[new]
                n = np.bincount(i, copies[p + j], q - p) + np.bincount(j, copies[p + i], q - p)
                some = np.flatnonzero(n)
                joined = np.array(_forest(linked)) + p
                a_ += [node[p + some], node[joined[:, 0]]]
                b_ += [np.full(len(some), -1), node[joined[:, 1]]]
                n_ += [n[some].astype(np.int64), np.zeros(len(joined), np.int64)]
            if a_:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in (a_, b_, n_)], names=["a", "b", "n"])

    return blocks.together(met, "key").mapInArrow(work, "a long, b long, n long").withColumn("b", F.when(F.col("b") >= 0, F.col("b")))


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, tables: int | None = None, planes: int | None = None, key: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """Per row: key, n_links (other rows linked directly), component_id (smallest key reachable), kept.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, and
    so do vectors of different lengths. Repeated rows are vectors of their own. A null key is never
    a component's name unless all of its keys are null; an empty table gives an empty one. Without
    ``tables`` and ``planes`` (give both or none) they follow from the number of different vectors.
    """
    importable(vectors.sparkSession)
    rows = vectors.select(F.col(key).cast("long").alias(key), F.col(embedding).alias("embedding"))
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    sound = F.coalesce(F.forall("embedding", number) & F.exists("embedding", lambda x: x != 0), F.lit(False))
    classes = rows.where(sound).groupBy("embedding").agg(F.min(key).alias("first"), F.count("*").alias("copies"))
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    if tables is None or planes is None:
        tables, planes = layout(classes.count(), threshold)
    found = written(hashed(classes, tables, planes), "hashed")
    met = written(links(found, threshold, tables, planes), "met")
    direct = met.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    member = components(met.where("b is not null"))
    named = classes.join(member, "node", "left").withColumn("root", F.coalesce("component", "node"))
    names = named.groupBy("root").agg(F.min("first").alias("name"))
    each = named.join(names, "root").join(direct, "node", "left")
    each = each.select("embedding", "name", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"))
    out = rows.withColumn("sound", sound).withColumn("match", F.when(F.col("sound"), F.col("embedding")))
    out = out.join(each.withColumnRenamed("embedding", "match"), "match", "left")
    component = F.when(F.col("sound"), F.col("name")).otherwise(F.col(key))
    out = out.select(key, F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
    return out.withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))
