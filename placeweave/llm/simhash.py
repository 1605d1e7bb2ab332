"""SimHash near-duplicates with pigeonring filtering.

Fingerprints have four segments of 16 bits in a ring. If two differ in at most three bits, there
is a segment from which on the first l segments differ in at most l * 3/4 bits, for every l: none
in the first, one in the first two, two in three. So such a pair shares a whole segment and a half
of the next, by which candidates are grouped; the rest of the chain is tested before the full
distance. Copies of a fingerprint are one node. A block of candidates yields a spanning forest of
its links, never all pairs.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeweave.llm import blocks
from placeweave.llm.common import importable, text_rows, worker_store, written
from placeweave.llm.components import components

SEGMENTS, SEGMENT_BITS, SEED = 4, 16, 42
#: Text that is cut into words at once.
SLICE_BYTES = 1 << 20
#: Rows of a chunk of a large group of candidates.
CHUNK_ROWS = 1000
SPACE = re.compile(rb"[\x20\x09-\x0d]")


def fingerprint(text: str, width: int = 3) -> int:
    """64 bits, each set where over half of the shingles' hashes have it; 0 without words."""
    data, at, carry = text.encode().lower(), 0, []
    ones, n = np.zeros(64, np.int64), 0
    hashed = xxhash.xxh64_intdigest
    while at < len(data):
        end = at + SLICE_BYTES
        cut = SPACE.search(data, end) if end < len(data) else None
        end = cut.start() if cut else len(data)
        words = carry + data[at:end].split()
        at, carry = end, words[-(width - 1) :]
        if len(words) >= width:
            joined = b" ".join(words)
            size = np.fromiter(map(len, words), np.int64, len(words))
            ends = np.cumsum(size + 1) - 1
            found = [hashed(joined[a:b], SEED) for a, b in zip((ends - size)[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())]
            bits = np.unpackbits(np.array(found, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones, n = ones + bits.sum(axis=0, dtype=np.int64), n + len(found)
    if not n:
        return hashed(b" ".join(carry), SEED) if carry else 0
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", more: Iterable[str] = ()) -> DataFrame:
    """(key, bits): the fingerprint of each row as a signed long; null texts have no words. Longs named in ``more`` come along."""
    importable(docs.sparkSession)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_store("simhash")
        for batch in batches:
            found = np.array([fingerprint(x.as_py()) for x in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found), *batch.columns[2:]], names=[key, "bits", *more])

    return text_rows(docs, key, text, list(more)).mapInArrow(work, ", ".join(f"{c} long" for c in (key, "bits", *more)))


def chained(x: np.ndarray, turn: np.ndarray | int) -> np.ndarray:
    """Whether differences x keep the budgets of the chain from segment ``turn`` on, and are three at most."""
    turn = np.asarray(turn).astype(np.uint64) * np.uint64(SEGMENT_BITS)
    y = (x << turn) | (x >> ((np.uint64(64) - turn) & np.uint64(63)))
    ok = y >> np.uint64(48) == 0
    for budget, shift in ((1, 32), (2, 16), (3, 0)):
        ok &= np.bitwise_count(y >> np.uint64(shift)) <= budget
    return ok


def forest(bits: np.ndarray, chunk: np.ndarray, turn: int, across: bool) -> list[tuple[int, int]]:
    """Places (root, member) that join all that is linked in a block; across: between its chunks only."""
    found, left = [], np.arange(len(bits))
    while len(left):
        root, left = left[0], left[1:]
        queue = [root]
        while queue and len(left):
            p = queue.pop()
            hit = chained(bits[left] ^ bits[p], turn)
            if across:
                hit &= chunk[left] != chunk[p]
            new, left = left[hit].tolist(), left[~hit]
            found += [(root, q) for q in new]
            queue += new
    return found


def links(nodes: DataFrame) -> DataFrame:
    """(a, b) that connect all ``bits`` within three bits of each other; nodes: distinct ``bits``."""
    importable(nodes.sparkSession)
    segment = lambda i: F.shiftrightunsigned("bits", 48 - 16 * (i % 4)).bitwiseAND(0xFFFF)
    keys = F.array(*(
        F.lit((2 * i + j) << 24).bitwiseOR(F.shiftleft(segment(i), 8)).bitwiseOR(F.shiftright(segment(i + 1), 8 - 8 * j).bitwiseAND(0xFF))
        for i in range(SEGMENTS) for j in range(2)
    ))
    rows = nodes.select("bits", F.explode(keys).alias("key"))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, at in blocks.runs(batches, "key", "low", "high"):
            bits, chunk = table.column("bits").to_numpy(), table.column("chunk").to_numpy()
            turn = table.column("key").to_numpy() >> 25
            words, size = bits.view(np.uint64), np.diff(at)
            across = (table.column("low").to_numpy() != table.column("high").to_numpy())[at[:-1]]
            group = np.repeat(np.arange(len(size)), size)
            pairs = [np.zeros((0, 2), np.int64)]
            two = np.flatnonzero((group[1:] == group[:-1]) & (size == 2)[group[1:]])  # most blocks have two rows
            two = two[chained(words[two] ^ words[two + 1], turn[two]) & (~across[group[two]] | (chunk[two] != chunk[two + 1]))]
            pairs.append(np.stack([two, two + 1], axis=1))
            for k in np.flatnonzero(size > 2).tolist():
                a, b = int(at[k]), int(at[k + 1])
                found = forest(words[a:b], chunk[a:b], int(turn[a]), bool(across[k]))
                if found:
                    pairs.append(np.array(found) + a)
            pairs = np.concatenate(pairs)
            yield pa.RecordBatch.from_arrays([pa.array(bits[pairs[:, 0]]), pa.array(bits[pairs[:, 1]])], names=["a", "b"])

    return blocks.together(blocks.dealt(rows, "key", "bits", CHUNK_ROWS), "key").mapInArrow(work, "a long, b long")


def groups(nodes: DataFrame) -> DataFrame:
    """nodes (distinct ``bits``) with ``root``, the same for all that links connect."""
    joined = nodes.join(components(links(nodes.select("bits"))).withColumnRenamed("node", "bits"), "bits", "left")
    return joined.withColumn("root", F.coalesce("component", "bits")).drop("component")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of near duplicates: that with the smallest key, null last; among rows of a key any.

    Rows are told apart by 128 bits of key and text, so a null or repeated key takes no other text along. Rows
    alike in both are one before they are shuffled, and texts are shuffled once. An empty table gives an empty one.
    """
    own = [F.xxhash64(F.lit(n), key, text).alias(c) for n, c in ((1, "row1"), (2, "row2"))]
    rows = docs.select("*", *own)
    found = written(fingerprints(rows, key, text, ("row1", "row2")), "fingerprints")
    best = F.min(F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), "row1", "row2")).alias("best")
    nodes = written(found.groupBy("bits").agg(best), "nodes")
    kept = written(groups(nodes).groupBy("root").agg(F.min("best").alias("best")).select("best.row1", "best.row2"), "kept")
    return rows.dropDuplicates(["row1", "row2"]).join(kept, ["row1", "row2"], "left_semi").select(docs.columns)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, fingerprint (16 hex digits), component_id (the smallest key reachable by links).

    Texts without words (null and empty ones) have fingerprint 0 and are linked like others.
    Repeated rows come out repeatedly, in one component; a null key is never a component's name
    unless all of its keys are null; an empty table gives an empty one.
    """
    found = written(fingerprints(docs, key, text), "fingerprints")
    nodes = written(found.groupBy("bits").agg(F.min(key).alias("first")), "nodes")
    member = groups(nodes)
    names = member.groupBy("root").agg(F.min("first").alias("component_id"))
    named = member.join(names, "root").select("bits", "component_id")
    return found.join(named, "bits", "left").select(key, F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")
