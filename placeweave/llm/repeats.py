"""Bytes covered by long strings that occur more than once, by parsing at rolling-hash triggers.

Every window of ``length`` bytes has a trigger: the place of the smallest hash of its 8-byte grams,
the first if several. It depends on the window's bytes alone, so equal windows have theirs at the
same place, and triggers parse equal text into equal phrases. Windows with the same trigger are
one run of starts. For a run (cut where its distance to the trigger passes a quarter of the length)

    core = the bytes that all its windows hold      span = all bytes of its windows

go by hash into one table, the dictionary. A core that is nowhere else: none of the run's windows
repeats. A span that is elsewhere too: all do. Only where a core has several spans, at the edges
of repeats, and one of them is there once, windows are compared one by one, those of one row of each
such span.

A task sends one row of each span that it has several times, and deals the others out by row, so
a string that is in a third of all texts comes to a task of the next stage once for each task of
the one before.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeweave.llm import blocks
from placeweave.llm.common import importable, text_rows, written

GRAM, FACTOR = 8, np.uint64(0x9E3779B97F4A7C15)
#: Windows whose triggers are found at once, and rows that a task compares before it sends them.
SLICE, BLOCK_ROWS = 1 << 20, 500_000
#: Place of a run: its first start, the last start less the first, packed into one number.
SHIFT = 10
#: Runs are cut by their distance to the trigger into so many parts.
PARTS = 4
ROWS = "deal long, span long, doc long, text_hash int, place long, state int"
SINGLE, FIRST, FURTHER = 0, 1, 2  # the only row of its span in its block, the first of several, another
REPEATED, EXPAND = 0, 1


def triggers(data: bytes, length: int) -> np.ndarray:
    """The trigger of each window of ``data``."""
    n, out = len(data) - length + 1, []
    grams = length - GRAM + 1
    for at in range(0, max(n, 0), SLICE):
        piece = np.frombuffer(data, np.uint8)[at : min(len(data), at + SLICE + length - 1)]
        count = len(piece) - GRAM + 1
        x = np.lib.stride_tricks.as_strided(piece, (count, GRAM), (1, 1)).copy().view("<u8").ravel() * FACTOR
        x = (x ^ (x >> np.uint64(29))) * FACTOR
        x = (x >> np.uint64(22) << np.uint64(22)) | np.arange(count, dtype=np.uint64)
        full = np.full(-(-count // grams) * grams, np.uint64(2**64 - 1))
        full[:count] = x
        full = full.reshape(-1, grams)
        ahead = np.minimum.accumulate(full, axis=1).ravel()
        behind = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
        windows = count - grams + 1
        out.append((np.minimum(behind[:windows], ahead[grams - 1 : grams - 1 + windows]) & np.uint64(2**22 - 1)).astype(np.int64) + at)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def parse(data: bytes, length: int) -> list[tuple[int, int, int, int]]:
    """(core hash, span hash, first start, further starts) of each run."""
    found = triggers(data, length)
    if not len(found):
        return []
    part = -(-length // PARTS)
    start = np.arange(len(found))
    far = (found - start) // part
    begins = np.flatnonzero(np.concatenate([[True], (found[1:] != found[:-1]) | (far[1:] != far[:-1])]))
    ends = np.append(begins[1:], len(found)) - 1
    core = found[begins] - part * far[begins]
    hashed, rows = xxhash.xxh3_64_intdigest, []
    for c, f, a, b in zip(core.tolist(), far[begins].tolist(), begins.tolist(), ends.tolist()):
        rows.append((hashed(data[c : c + length - part + 1], f), hashed(data[a : b + length], c - a), a, b - a))
    return rows


def signed(x: list[int]) -> np.ndarray:
    return np.array(x, np.uint64).view(np.int64)


def combined(rows: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
    """ROWS of (core or first half of a hash, span or second half, doc, text_hash, start, more), block by block."""

    def block(held: list[tuple]) -> pa.RecordBatch:
        core, span, doc, text_hash, start, more = zip(*held)
        core, span = signed(core), signed(span)
        order = np.lexsort((span, core))
        same = np.zeros(len(order) + 1, bool)
        same[1:-1] = (core[order][1:] == core[order][:-1]) & (span[order][1:] == span[order][:-1])
        state = np.empty(len(order), np.int32)
        state[order] = np.where(same[:-1], FURTHER, np.where(same[1:], FIRST, SINGLE))
        place = np.array(start, np.int64) << SHIFT | np.array(more, np.int64)
        doc = np.array(doc, np.int64)
        spread = (doc * 1_000_003 + place).view(np.uint64) * FACTOR
        deal = np.where(state == FURTHER, spread.view(np.int64), core)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (deal, span, doc, np.array(text_hash, np.int32), place, state)], names=[c.split()[0] for c in ROWS.split(", ")])

    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= BLOCK_ROWS:
            yield block(held)
            held = []
    if held:
        yield block(held)


def compared(rows: DataFrame) -> DataFrame:
    """(doc, text_hash, place, what): REPEATED runs, and those to EXPAND."""
    dealt = rows.repartition("deal").sortWithinPartitions("deal", "span")

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, at in blocks.runs(batches, "deal"):
            span, state = table.column("span").to_numpy(), table.column("state").to_numpy()
            group = np.repeat(np.arange(len(at) - 1), np.diff(at))
            live = np.flatnonzero(state != FURTHER)
            new = np.ones(len(live) + 1, bool)
            new[1:-1] = (group[live][1:] != group[live][:-1]) | (span[live][1:] != span[live][:-1])
            repeated = state != SINGLE
            repeated[live] |= ~new[:-1] | ~new[1:]
            spans = np.bincount(group[live][new[:-1]], minlength=len(at) - 1)
            unsure = np.bincount(group[live][~repeated[live]], minlength=len(at) - 1)
            expand = live[new[:-1] & (spans[group[live]] > 1) & (unsure[group[live]] > 0)]
            take = np.concatenate([np.flatnonzero(repeated), expand])
            what = np.repeat([REPEATED, EXPAND], [repeated.sum(), len(expand)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*(table.column(c).combine_chunks().take(pa.array(take)) for c in ("doc", "text_hash", "place")), pa.array(what)], names=["doc", "text_hash", "place", "what"])

    return dealt.mapInArrow(work, "doc long, text_hash int, place long, what int")


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    rows = text_rows(docs, key, text)
    # texts are told apart by key, and by hash where a key is there more than once
    return rows.select(key, text, F.coalesce(key, F.lit(-1)).alias("doc"), F.xxhash64(text).bitwiseAND(0x7FFFFFFF).cast("int").alias("text_hash"))


def _rows(batches: Iterable[pa.RecordBatch], each: Callable) -> Iterator[tuple]:
    for batch in batches:
        for doc, text_hash, text, *more in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), *batch.columns[3:]):
            for row in each(text.as_py().encode(), *more):
                yield row[0], row[1], doc, text_hash, row[2], row[3]


def spans(docs: DataFrame, length: int = 400, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, text_hash, places): runs of repeated windows of each text that has any, packed."""
    importable(docs.sparkSession)
    texts = _texts(docs, key, text).select("doc", "text_hash", text)

    def parsed(batches):
        return combined(_rows(batches, lambda data: parse(data, length)))

    runs = written(compared(texts.mapInArrow(parsed, ROWS)), "runs")
    listed = F.sort_array(F.collect_list("place")).alias("places")
    open_ = runs.where(f"what = {EXPAND}").groupBy("doc", "text_hash").agg(listed)

    def windows(data, places):
        for place in places.as_py():
            for s in range(place >> SHIFT, (place >> SHIFT) + (place & (1 << SHIFT) - 1) + 1):
                h = xxhash.xxh3_128_intdigest(data[s : s + length])
                yield h >> 64, h & 2**64 - 1, s, 0

    def expanded(batches):
        return combined(_rows(batches, windows))

    single = compared(texts.join(open_, ["doc", "text_hash"]).select("doc", "text_hash", text, "places").mapInArrow(expanded, ROWS))
    both = runs.unionByName(single).where(f"what = {REPEATED}")
    return both.groupBy("doc", "text_hash").agg(listed)


def merged(places: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal (start, end) of the bytes covered."""
    out: list[tuple[int, int]] = []
    for a, more in zip((places >> SHIFT).tolist(), (places & (1 << SHIFT) - 1).tolist()):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], a + more + length))
        else:
            out.append((a, a + more + length))
    return out


def without_repeats(docs: DataFrame, length: int = 400, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256, kept (the bytes left).

    A byte goes if a string of ``length`` bytes that covers it also starts elsewhere, in this text or
    another; the rows are one text each, so all of a row that is there twice goes if it is that long.
    Null texts are empty; texts shorter than ``length`` stay whole; an empty table gives an empty one.
    """
    if not 16 <= length < 1 << SHIFT:
        raise ValueError(f"length must be from 16 to {(1 << SHIFT) - 1}")
    found = spans(docs, length, key, text)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for x, places in zip(batch.column(1), batch.column(2)):
                data = x.as_py().encode()
                runs = merged(places.values.to_numpy(), length) if places.is_valid else []
                kept = b"".join(data[a:b] for a, b in zip([0, *(e for _, e in runs)], [*(s for s, _ in runs), len(data)]))
                rows.append((len(data), len(data) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), kept))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 5, kinds))], names=[key, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    rows = _texts(docs, key, text).join(found, ["doc", "text_hash"], "left").select(key, text, "places")
    return rows.mapInArrow(work, f"{key} long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
