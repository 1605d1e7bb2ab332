"""Token ids as files of patched frame-of-reference blocks, and their reader.

The files are Parquet with one row per segment (``part``, ``segment``, ``first``: ids before it
in its part, ``n_ids``, ``data``), so any store Spark writes to will do. Parts and segments are in
ascending order of doc_id, and a segment ends with a document. ``data``, all little-endian:

    magic "PFR1" | documents u32 | ids u32 | blocks u32
    doc_id i64 each | without doc_id u8 each | ids before the document in this segment u32 each
    byte at which each block starts, from the first, u32 each, and the end
    blocks: minimum u32 | width u8 | exceptions u16 | ids minus minimum, `width` bits each,
            those of exceptions cut | their places u8 each | what was cut off, u32 each

A block has 256 ids, the last one fewer. Its width is what the given percentile of its
differences needs; larger ones are exceptions, whose higher bits are listed.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeweave.llm.common import importable, shared_folder, text_rows
from placeweave.llm.tokens import Encoder

MAGIC, HEAD, BLOCK_HEAD, BLOCK = b"PFR1", struct.Struct("<4sIII"), struct.Struct("<IBH"), 256
FILES = "part int, segment int, first long, n_ids long, data binary"


def _bits(x: np.ndarray) -> np.ndarray:
    return np.frexp(x.astype(np.float64))[1].astype(np.uint8)


def _holds(width: int) -> str:
    """The smallest kind of number with so many bits."""
    return "<u2" if width <= 16 else "<u4"


def pack_ids(ids: np.ndarray, percentile: float = 0.9) -> list[bytes]:
    """The blocks of ids."""
    n = -(-len(ids) // BLOCK)
    full = np.concatenate([ids, np.full(n * BLOCK - len(ids), ids[-1] if len(ids) else 0, np.uint32)]).reshape(n, BLOCK).astype(np.uint32)
    low = full.min(axis=1)
    rest = full - low[:, None]
    bits = _bits(rest)
    width = np.sort(bits, axis=1)[:, min(BLOCK - 1, int(percentile * BLOCK))]
    over = bits > width[:, None]
    blocks: list[bytes] = [b""] * n
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        kind = _holds(int(w))
        each = np.unpackbits(rest[at].astype(kind).view(np.uint8), axis=1, bitorder="little").reshape(len(at), BLOCK, -1)
        packed = np.packbits(each[:, :, :w].reshape(len(at), -1), axis=1, bitorder="little")
        for k, b in zip(at.tolist(), packed):
            b = b.tobytes()
            if k == n - 1:
                b = b[: -(-(len(ids) - k * BLOCK) * int(w) // 8)]
            places = np.flatnonzero(over[k])
            blocks[k] = BLOCK_HEAD.pack(low[k], w, len(places)) + b + places.astype("u1").tobytes() + (rest[k, places].astype(np.uint64) >> np.uint64(w)).astype("<u4").tobytes()
    return blocks


def unpack_ids(data: memoryview, starts: np.ndarray, n_ids: int) -> np.ndarray:
    """The ids of the blocks that start at ``starts`` (one more: the end)."""
    n = len(starts) - 1
    out = np.zeros((n, BLOCK), np.uint32)
    heads = [BLOCK_HEAD.unpack_from(data, s) for s in starts[:-1].tolist()]
    width = np.array([h[1] for h in heads], np.int64)
    for w in np.unique(width).tolist():
        at = np.flatnonzero(width == w)
        size = BLOCK * w // 8
        raw = np.zeros((len(at), size), np.uint8)
        for row, k in enumerate(at.tolist()):
            count = min(BLOCK, n_ids - k * BLOCK)
            begin = int(starts[k]) + BLOCK_HEAD.size
            b = np.frombuffer(data[begin : begin + -(-count * w // 8)], np.uint8)
            raw[row, : len(b)] = b
        if w:
            kind = np.dtype(_holds(w))
            each = np.zeros((len(at), BLOCK, 8 * kind.itemsize), np.uint8)
            each[:, :, :w] = np.unpackbits(raw, axis=1, bitorder="little").reshape(len(at), BLOCK, w)
            out[at] = np.packbits(each.reshape(len(at), -1), axis=1, bitorder="little").view(kind)
    for k, (low, w, over) in enumerate(heads):
        if over:
            begin = int(starts[k]) + BLOCK_HEAD.size + -(-min(BLOCK, n_ids - k * BLOCK) * w // 8)
            places = np.frombuffer(data[begin : begin + over], np.uint8)
            out[k, places] |= (np.frombuffer(data[begin + over : begin + 5 * over], "<u4").astype(np.uint64) << np.uint64(w)).astype(np.uint32)
        out[k] += np.uint32(low)
    return out.reshape(-1)[:n_ids]


def segment(doc_ids: list[int | None], ids: list[bytes], percentile: float = 0.9) -> bytes:
    """A segment of documents, given their ids as little-endian unsigned 32-bit numbers."""
    lengths = np.array([len(x) // 4 for x in ids], np.int64)
    all_ids = np.frombuffer(b"".join(ids), "<u4")
    blocks = pack_ids(all_ids, percentile)
    starts = np.concatenate([[0], np.cumsum([len(b) for b in blocks], dtype=np.int64)])
    return b"".join([
        HEAD.pack(MAGIC, len(ids), len(all_ids), len(blocks)),
        np.array([x or 0 for x in doc_ids], "<i8").tobytes(),
        np.array([x is None for x in doc_ids], "u1").tobytes(),
        (np.cumsum(lengths) - lengths).astype("<u4").tobytes(),
        starts.astype("<u4").tobytes(),
        *blocks,
    ])


class Segment:
    """Reads a segment: documents by place, or any range of ids without unpacking the rest."""

    def __init__(self, data: bytes):
        magic, n_docs, self.n_ids, n_blocks = HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a segment of token ids")
        at = HEAD.size

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            at += (size := np.dtype(kind).itemsize * n)
            return np.frombuffer(data[at - size : at], kind)

        keys, without = take("<i8", n_docs), take("u1", n_docs)
        self.doc_ids = [None if w else k for k, w in zip(keys.tolist(), without.tolist())]
        self.starts = np.concatenate([take("<u4", n_docs), [self.n_ids]]).astype(np.int64)
        self.blocks = take("<u4", n_blocks + 1).astype(np.int64)
        self.data = memoryview(data)[at:]

    def ids(self, start: int = 0, end: int | None = None) -> np.ndarray:
        end = self.n_ids if end is None else min(end, self.n_ids)
        first, last = start // BLOCK, -(-end // BLOCK)
        if first >= last:
            return np.zeros(0, np.uint32)
        found = unpack_ids(self.data, self.blocks[first : last + 1], min(self.n_ids, last * BLOCK) - first * BLOCK)
        return found[start - first * BLOCK : end - first * BLOCK]


def write_ids(docs: DataFrame, path: str, vocabulary: str, ranks: str | None = None, end_id: int = 2, segment_ids: int = 1 << 16, percentile: float = 0.9) -> None:
    """Writes every row's ids and ``end_id`` in ascending order of doc_id.

    Rows without doc_id come first, null texts are empty, rows with the same doc_id stand next to
    each other, the order of their texts; an empty table gives files without rows.
    """
    spark = docs.sparkSession
    importable(spark)
    end = np.array([end_id], "<u4").tobytes()

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = Encoder.of_worker(vocabulary, ranks), TaskContext.get().partitionId()
        keys, ids, size, first, number = [], [], 0, 0, 0

        def close() -> pa.RecordBatch:
            row = {"part": part, "segment": number, "first": first, "n_ids": size, "data": segment(keys, ids, percentile)}
            return pa.RecordBatch.from_pylist([row], schema=pa.schema([("part", pa.int32()), ("segment", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()), ("data", pa.binary())]))

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = encoder.ids(text.as_py()) + end
                keys.append(key)
                ids.append(found)
                size += len(found) // 4
                if size >= segment_ids:
                    yield close()
                    keys, ids, size, first, number = [], [], 0, first + size, number + 1
        if keys:
            yield close()

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = text_rows(docs).repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    # ids hardly shrink further
    dealt.mapInArrow(write, FILES).write.option("compression", "uncompressed").parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    importable(spark)
    files = spark.read.schema(FILES).parquet(path)
    before, total = {}, 0
    for r in files.groupBy("part").agg(F.sum("n_ids").alias("n")).sort("part").toLocalIterator():  # one number per part
        before[r["part"]], total = total, total + r["n"]

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, first, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                s = Segment(data.as_py())
                ids = memoryview(s.ids().astype("<u4").tobytes())
                ends = s.starts.tolist()
                crc = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(s.doc_ids, pa.int64()), pa.array(s.starts[:-1] + before[part] + first), pa.array(np.diff(s.starts)), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.select("part", "first", "data").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, vocabulary: str, ranks: str | None = None, end_id: int = 2) -> DataFrame:
    """Writes the files into the shared folder and reads them back."""
    path = f"{shared_folder(docs.sparkSession)}/token-files-{uuid.uuid4().hex[:12]}"
    write_ids(docs, path, vocabulary, ranks, end_id)
    return read_documents(docs.sparkSession, path)
