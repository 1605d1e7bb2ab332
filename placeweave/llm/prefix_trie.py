"""Prefix trie of conversations, with totals of subtrees by time-forward processing.

A node is a distinct sequence of first turns. It is told by its depth and 128 bits, the exclusive or of
a hash of each turn and its place; such prefixes of a conversation can be made in pieces, so that a long
conversation lies in many tasks. Counts of nodes are aggregated before they are shuffled.

Totals go from the leaves to the root. Heavy nodes, with more than a hundred-thousandth of all rows (and
LEAST conversations), are fewer than SHARE, and a node's ancestors are at least as heavy. So below them hang
light subtrees of bounded width, dealt to shards by their roots. In a shard, nodes come in reverse order of
levels from Spark's external sort, and each sends its totals to its parent by a priority queue that spills to
disk; the totals of shard roots go to the heavy nodes, at most SHARE and the root, which are processed alike.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import struct
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placeweave.llm.common import importable, written

SHARE, LEAST = 100_000, 50
#: Messages of a task that are held in memory, and spilled runs that are read at once.
HELD, RUNS = 200_000, 32
ID = ["depth", "id1", "id2"]
TOTALS = ["n_children", "n_leaves", "saved_tokens"]


# ---- order: places in a conversation, prefixes

def _mixed(x: np.ndarray, at: np.ndarray, odd: int) -> np.ndarray:
    x = x + at.astype(np.uint64) * np.uint64(odd)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _runs(keys: np.ndarray, last: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Starts of runs of equal keys, and for each row its run; the first may go on from ``last``."""
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    if last is not None and keys[0] == last:
        new[0] = False
    return np.flatnonzero(new), np.cumsum(new)


def places(conversations: DataFrame) -> DataFrame:
    """(conv_id, at, a, b, chars): each turn's place from 1, 128 bits of its role and text, and the text's code points."""
    importable(conversations.sparkSession)
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    rows = conversations.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), said("role"), said("text"))
    rows = rows.withColumn("read", F.monotonically_increasing_id()).orderBy("conv_id", F.col("turn").asc_nulls_first(), "role", "text", "read")

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, count, part = None, 0, TaskContext.get().partitionId()
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column(0).to_numpy()
            starts, run = _runs(conv, last)
            first = np.concatenate([[-count], starts])[run]
            at = np.arange(len(conv)) - first + 1
            last, count = int(conv[-1]), int(at[-1])
            data, chars = bytearray(), []
            for role, text in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                role = role.encode()
                data += hashlib.blake2b(len(role).to_bytes(8, "little") + role + text.encode(), digest_size=16).digest()
                chars.append(len(text))
            bits = np.frombuffer(bytes(data), "<i8").reshape(-1, 2)
            columns = [batch.column(0), pa.array(np.full(len(conv), part)), pa.array(at), pa.array(bits[:, 0]), pa.array(bits[:, 1]), pa.array(chars, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "part", "at", "a", "b", "chars"])

    found = written(rows.mapInArrow(work, "conv_id long, part long, at long, a long, b long, chars long"), "turns")
    cut = found.groupBy("conv_id", "part").agg(F.max("at").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # a border between two parts of the order cuts one conversation, so there are fewer rows than parts
    more = cut.withColumn("before", F.sum("n").over(before)).where("before is not null").select("conv_id", "part", "before")
    return found.join(F.broadcast(more), ["conv_id", "part"], "left").select("conv_id", (F.col("at") + F.coalesce("before", F.lit(0))).alias("at"), "a", "b", "chars")


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, id1, id2, up1, up2, chars): each turn as the end of a prefix, with the prefix before. turns: as ``places`` has them."""
    importable(turns.sparkSession)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held, part = None, np.zeros(2, np.uint64), TaskContext.get().partitionId()
        for batch in batches:
            if not batch.num_rows:
                continue
            conv, at = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            starts, run = _runs(conv, last)
            columns = []
            for k, odd in enumerate((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)):
                x = np.bitwise_xor.accumulate(np.concatenate([held[k : k + 1], _mixed(batch.column(2 + k).to_numpy().view(np.uint64), at, odd)]))
                base = np.concatenate([np.zeros(1, np.uint64), x[starts]])[run]  # what lies before the conversation
                columns += [x[1:] ^ base, x[:-1] ^ base]
                held[k] = columns[-2][-1]
            last = int(conv[-1])
            id1, up1, id2, up2 = (pa.array(c.view(np.int64)) for c in columns)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.full(len(conv), part)), batch.column(1), id1, id2, up1, up2, batch.column(4)], names=["conv_id", "part", "depth", "id1", "id2", "up1", "up2", "chars"])

    found = turns.orderBy("conv_id", "at").mapInArrow(work, "conv_id long, part long, depth long, id1 long, id2 long, up1 long, up2 long, chars long")
    found = written(found, "prefixes")
    ends = found.groupBy("conv_id", "part").agg(F.max_by(F.struct("id1", "id2"), "depth").alias("end"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    more = ends.select("conv_id", "part", *(F.bit_xor(f"end.{c}").over(before).alias(f"x{c[-1]}") for c in ("id1", "id2"))).where("x1 is not null")
    whole = found.join(F.broadcast(more), ["conv_id", "part"], "left")  # fewer rows than parts, as above
    with_before = lambda c: F.col(c).bitwiseXOR(F.coalesce(F.col(f"x{c[-1]}"), F.lit(0).cast("long"))).alias(c)
    return whole.select("conv_id", "depth", *map(with_before, ("id1", "id2", "up1", "up2")), "chars")


def rebuilt(turns: DataFrame, block: int = 100, most: int = 6) -> DataFrame:
    """Conversations c that begin with the first h turns of c - c mod block, h = CRC-32 of c mod ``most``, and go on after their own first h.

    turns and result: as ``places`` has them; conversations left without turns are not in it.
    """
    source, h = F.col("conv_id") - F.pmod("conv_id", F.lit(block)), F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    heads = turns.where((F.pmod("conv_id", F.lit(block)) == 0) & (F.col("at") < most)).select(F.col("conv_id").alias("source"), "at", "a", "b", "chars")
    sizes = heads.groupBy("source").agg(F.count("*").alias("size"))
    convs = turns.select("conv_id").distinct().select("conv_id", source.alias("source"), h.alias("h")).join(sizes, "source", "left")
    convs = convs.select("conv_id", "source", F.least("h", F.coalesce("size", F.lit(0))).alias("taken"))
    begin = convs.where("taken > 0").join(heads, "source").where("at <= taken").select("conv_id", "at", "a", "b", "chars")
    own = turns.where(F.col("at") > h).join(convs.select("conv_id", "taken"), "conv_id")
    return begin.unionByName(own.select("conv_id", (F.col("at") - h + F.col("taken")).alias("at"), "a", "b", "chars"))


# ---- time-forward processing

class SpillingQueue:
    """Messages (key, values) in ascending order of their keys; beyond ``held`` of them, sorted runs go to temporary files."""

    RECORD = struct.Struct("<6q")

    def __init__(self, held: int = HELD, runs: int = RUNS):
        self.held, self.most, self.heap, self.files, self.spilled = held, runs, [], [], 0

    def push(self, message: tuple[int, ...]) -> None:
        heapq.heappush(self.heap, message)
        if len(self.heap) > self.held:
            self._spill(sorted(self.heap))
            self.heap = []
            if len(self.files) > self.most:
                old, self.files = self.files, []
                self._spill(heapq.merge(*map(self._all, old)))

    @staticmethod
    def _all(run: list) -> Iterator[tuple[int, ...]]:
        return itertools.chain(run[:1], run[2])

    def _spill(self, messages: Iterable[tuple[int, ...]]) -> None:
        file = tempfile.TemporaryFile()
        for m in messages:
            file.write(self.RECORD.pack(*m))
        file.seek(0)
        rest = self._read(file)
        self.spilled += 1
        heapq.heappush(self.files, [next(rest), self.spilled, rest])

    def _read(self, file) -> Iterator[tuple[int, ...]]:
        while data := file.read(self.RECORD.size << 10):
            yield from self.RECORD.iter_unpack(data)
        file.close()

    def pop_upto(self, key: tuple[int, ...]) -> Iterator[tuple[int, ...]]:
        """Takes out all messages whose key is at most ``key``."""
        n = len(key)
        while True:
            inside, outside = self.heap and self.heap[0][:n], self.files and self.files[0][0][:n]
            if inside and inside <= key and not (outside and outside < inside):
                yield heapq.heappop(self.heap)
            elif outside and outside <= key:
                run = self.files[0]
                yield run[0]
                if (head := next(run[2], None)) is None:
                    heapq.heappop(self.files)
                else:
                    heapq.heapreplace(self.files, [head, *run[1:]])
            else:
                return


def forward(nodes: DataFrame, held: int = HELD) -> DataFrame:
    """Nodes with totals added up. Each partition's nodes must come in order (deepest first, then by id), a node in that of its parent unless ``top``.

    nodes: ID, up1, up2, n_convs, chars, top, and TOTALS that came from elsewhere.
    """
    importable(nodes.sparkSession)
    names = [*ID, *TOTALS]

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = SpillingQueue(held)
        for batch in batches:
            out = []
            for depth, id1, id2, up1, up2, n, chars, top, children, leaves, saved in zip(*(c.to_pylist() for c in batch.columns)):
                for *_, more_leaves, more_saved in queue.pop_upto((-depth, id1, id2)):
                    children, leaves, saved = children + 1, leaves + more_leaves, saved + more_saved
                leaves, saved = leaves if children else 1, saved + (n - 1) * chars
                if not top:
                    queue.push((1 - depth, up1, up2, 0, leaves, saved))
                out.append((depth, id1, id2, children, leaves, saved))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=names)

    return nodes.select(*ID, "up1", "up2", "n_convs", "chars", "top", *TOTALS).mapInArrow(work, ", ".join(f"{c} long" for c in names))


def _in_order(nodes: DataFrame) -> DataFrame:
    return nodes.sortWithinPartitions(F.desc("depth"), "id1", "id2")


def _no_totals() -> list:
    return [F.lit(0).cast("long").alias(c) for c in TOTALS]


def totals(steps: DataFrame, nodes: DataFrame, least: int = LEAST, share: int = SHARE, held: int = HELD) -> DataFrame:
    """(ID, conv_id, n_convs, TOTALS, parent_conv_id) of all nodes. steps: ``prefixes``; nodes: ``trie_nodes`` of them."""
    n = nodes.agg(F.coalesce(F.sum("n_convs"), F.lit(0))).first()[0]
    heavy = nodes.where((F.col("n_convs") > max(least, -(-n // share))) | (F.col("depth") == 0))
    heavy = written(heavy, "heavy")  # fewer than ``share`` nodes and the root
    marks = F.broadcast(heavy.select(*ID, F.lit(True).alias("heavy")))
    below_heavy = F.broadcast(heavy.select((F.col("depth") + 1).alias("depth"), F.col("id1").alias("up1"), F.col("id2").alias("up2"), F.col("conv_id").alias("heavy_parent")))
    # light subtrees: the first light node of each conversation
    first = F.min(F.when(F.col("heavy").isNull(), F.struct(*ID))).alias("root")
    roots = steps.join(marks, ID, "left").groupBy("conv_id").agg(first).where("root is not null")
    light = nodes.join(marks, ID, "left_anti").join(roots, "conv_id").join(below_heavy, ["depth", "up1", "up2"], "left")
    light = light.withColumn("top", F.col("heavy_parent").isNotNull())
    light = written(light.select(*ID, "up1", "up2", "conv_id", "n_convs", "chars", "top", "heavy_parent", "root"), "light")
    done = written(forward(_in_order(light.select("*", *_no_totals()).repartition("root")), held), "shards")
    # totals of shard roots, sent to heavy nodes
    sent = light.where("top").join(done, ID).groupBy((F.col("depth") - 1).alias("depth"), F.col("up1").alias("id1"), F.col("up2").alias("id2"))
    sent = sent.agg(F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    upper = heavy.join(sent, ID, "left").select(*ID, "up1", "up2", "n_convs", "chars", (F.col("depth") == 0).alias("top"), *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in TOTALS))
    upper = forward(_in_order(upper.repartition(1)), held)
    # parents: those of light nodes are light, with ``least`` children or so at most, or heavy, and then broadcast
    inner = light.where("not top")
    parents = light.select((F.col("depth") + 1).alias("depth"), F.col("id1").alias("up1"), F.col("id2").alias("up2"), F.col("conv_id").alias("parent_conv_id"))
    known = [*ID, "conv_id", "n_convs"]
    named = inner.join(parents, ["depth", "up1", "up2"]).select(*known, "parent_conv_id")
    named = named.unionByName(light.where("top").select(*known, F.col("heavy_parent").alias("parent_conv_id")))
    named = named.unionByName(heavy.join(below_heavy, ["depth", "up1", "up2"], "left").select(*known, F.col("heavy_parent").alias("parent_conv_id")))
    return named.join(done.unionByName(upper), ID)


def trie_nodes(steps: DataFrame, ids: DataFrame) -> DataFrame:
    """(ID, up1, up2, conv_id, n_convs, chars): nodes with their smallest member and number of members, the root included."""
    below = steps.groupBy(*ID).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), *(F.max(c).alias(c) for c in ("up1", "up2", "chars")))
    zero = lambda c: F.lit(0).cast("long").alias(c)
    root = ids.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    columns = [*ID, "up1", "up2", "conv_id", "n_convs", "chars"]
    return below.select(columns).unionByName(root.select(*map(zero, (*ID, "up1", "up2")), "conv_id", "n_convs", zero("chars")))


def ends(steps: DataFrame, ids: DataFrame) -> DataFrame:
    """(ID, ends_sha256) of nodes at which conversations end: the digest of their ids, read in order by one task for each node."""
    last = steps.groupBy("conv_id").agg(F.max(F.struct(*ID)).alias("end"))
    zero = F.lit(0).cast("long")
    last = ids.join(last, "conv_id", "left").select(F.coalesce("end", F.struct(*(zero.alias(c) for c in ID))).alias("end"), "conv_id").select("end.*", "conv_id")

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            out = []
            for *key, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if key != node:
                    if node:
                        out.append((*node, digest.hexdigest()))
                    node, digest = key, hashlib.sha256(str(conv).encode())
                else:
                    digest.update(f",{conv}".encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=[*ID, "ends_sha256"])
        if node:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*node, digest.hexdigest())], names=[*ID, "ends_sha256"])

    return last.repartition(*ID).sortWithinPartitions(*ID, "conv_id").mapInArrow(work, "depth long, id1 long, id2 long, ends_sha256 string")


def trie(turns: DataFrame, ids: DataFrame, least: int = LEAST, share: int = SHARE, held: int = HELD) -> DataFrame:
    """Per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    turns: (conv_id, at, a, b, chars) as ``places`` has them; ids: conv_id of all conversations, also those without turns.
    A node is a distinct sequence of first turns, its members the conversations that begin with it; the root, of depth
    0, has no parent. An empty table gives an empty one.
    """
    steps = prefixes(turns)
    nodes = written(trie_nodes(steps, ids), "nodes")
    none = hashlib.sha256(b"").hexdigest()
    found = totals(steps, nodes, least, share, held).join(ends(steps, ids), ID, "left")
    numbers = [F.col(c).cast("long").alias(c) for c in ("depth", "parent_conv_id", "n_convs", *TOTALS)]
    return found.select("conv_id", *numbers, F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame, **bounds: int) -> DataFrame:
    """``trie`` of conversations as they are.

    Turns come in order of turn (null first), role and text; null roles and texts are empty; equal rows count one by
    one; rows without conv_id belong to no conversation and are left aside.
    """
    turns = written(places(conversations), "places")
    return trie(turns, turns.select("conv_id").distinct(), **bounds)


def rebuilt_trie(conversations: DataFrame, **bounds: int) -> DataFrame:
    """``trie`` of conversations as ``rebuilt`` makes them; rows are read as by ``conversation_trie``."""
    turns = written(places(conversations), "places")
    return trie(written(rebuilt(turns), "rebuilt"), turns.select("conv_id").distinct(), **bounds)
