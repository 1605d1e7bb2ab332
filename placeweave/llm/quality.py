"""Quality of texts: random-indexing word vectors, pooled by document, and a small network on top.

1. A text is a sequence of marks: hashes of words and of runs of other signs into BUCKETS, and three marks of
   their own for a word said again at once, a line said again, and a word in capitals.
2. Random indexing: every bucket has a sparse random index vector. A bucket's context vector is the sum
   of the index vectors of its neighbours within WINDOW marks, over all texts. Tasks add up their own
   texts, and BUCKETS x SIZE sums are all that goes on, whatever the size of the corpus.
3. A bucket's word vector is its index and its context vector, each of length 1, added up. A document's is the
   sum of its buckets' vectors by the root of their share of its marks.
4. Two layers (tanh, sigmoid) are fitted in numpy on at most FIT_ROWS labelled texts; one in five of these
   is kept back to choose the temperature by which scores are calibrated.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeweave.llm.common import importable, text_rows, worker_store, written

BUCKETS, SIZE, WINDOW, SIGNS = 8192, 64, 2, 4
FIT_ROWS, HIDDEN, SEED = 12_000, 24, 5
AGAIN, LINE_AGAIN, CAPITALS, FIRST_BUCKET = 0, 1, 2, 3
MARK = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+|\n+")
#: Characters cut into marks at once, marks added up at once, rows of vectors sent together, words a worker keeps.
SLICE_CHARS, ADD_MARKS, BLOCK, KEPT_WORDS = 1 << 18, 1 << 19, 64, 200_000


def learnable(key: str = "doc_id", folds: int = 3, held: int = 1) -> Column:
    """Whether a row's label may be learned: the CRC-32 of its key as text modulo ``folds`` isn't ``held``."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % folds != held


class Marks:
    """Texts as arrays of buckets; remembers the buckets of words it has seen."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def bucket(self, word: str) -> int:
        found = self.known.get(word)
        if found is None:
            lower = word.lower()
            found = CAPITALS if len(word) > 1 and word.isupper() else FIRST_BUCKET + xxhash.xxh32_intdigest(lower, SEED) % (BUCKETS - FIRST_BUCKET)
            if len(self.known) >= KEPT_WORDS:
                self.known.clear()
            self.known[word] = found
        return found

    def of(self, text: str) -> np.ndarray:
        """Buckets of a text's marks; lines are read in slices that end between words."""
        out, seen, at = [], set(), 0
        while at < len(text):
            end = text.find("\n", at)
            end = len(text) if end < 0 else end + 1
            said = text[at:end].strip()
            line = [self.bucket(w) for a in self._slices(at, end, text) for w in MARK.findall(text, *a)]
            digest = xxhash.xxh64_intdigest(said)
            out += [LINE_AGAIN] * len(line) if len(said) > 1 and digest in seen else line
            seen.add(digest)
            at = end
        marks = np.array(out, np.int32)
        again = np.zeros(len(marks), bool)
        again[1:] = (marks[1:] == marks[:-1]) & (marks[1:] >= FIRST_BUCKET)
        marks[again] = AGAIN
        return marks

    @staticmethod
    def _slices(at: int, end: int, text: str) -> Iterator[tuple[int, int]]:
        while at < end:
            cut = min(end, at + SLICE_CHARS)
            while cut < end and not text[cut].isspace():
                cut += 1
            yield at, cut
            at = cut


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of each bucket's index vector, the same wherever they are made."""
    places = np.random.default_rng(SEED).permuted(np.tile(np.arange(SIZE), (BUCKETS, 1)), axis=1)[:, :SIGNS]
    return places, np.where(np.arange(SIGNS) % 2, -1, 1)


def add_contexts(sums: np.ndarray, marks: np.ndarray, text_of: np.ndarray) -> None:
    """Adds to each mark's row the index vectors of its neighbours in the same text."""
    places, signs = index_vectors_of_worker()
    for step in range(1, WINDOW + 1):
        same = text_of[step:] == text_of[:-step]
        a, b = marks[:-step][same].astype(np.int64), marks[step:][same].astype(np.int64)
        for x, y in ((a, b), (b, a)):
            for k in range(SIGNS):
                sums += signs[k] * np.bincount(x * SIZE + places[y, k], minlength=BUCKETS * SIZE)


def index_vectors_of_worker() -> tuple[np.ndarray, np.ndarray]:
    own = worker_store("quality")
    if "vectors" not in own:
        own["vectors"] = index_vectors()
    return own["vectors"]


def contexts(texts: DataFrame) -> np.ndarray:
    """BUCKETS x SIZE sums of context vectors over all rows of ``texts`` (one column)."""
    importable(texts.sparkSession)

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, sums = Marks(), np.zeros(BUCKETS * SIZE, np.int64)
        held, size = [], 0

        def flush():
            nonlocal size
            if held:
                add_contexts(sums, np.concatenate(held), np.repeat(np.arange(len(held)), [len(m) for m in held]))
                held.clear()
                size = 0

        for batch in batches:
            for text in batch.column(0):
                held.append(reader.of(text.as_py()))
                size += len(held[-1])
                if size > ADD_MARKS:
                    flush()
        flush()
        rows = sums.reshape(-1, BLOCK * SIZE)
        some = np.flatnonzero(rows.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array([rows[k].astype("<i4" if abs(rows[k]).max() < 2**31 else "<i8").tobytes() for k in some], pa.binary())], names=["block", "sums"])

    def total(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}  # BUCKETS / BLOCK at most
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                x = np.frombuffer(data, "<i4" if len(data) == 4 * BLOCK * SIZE else "<i8")
                found[block] = found[block] + x if block in found else x.astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array([x.tobytes() for x in found.values()], pa.binary())], names=["block", "sums"])

    parts = texts.mapInArrow(add, "block int, sums binary").repartition("block").mapInArrow(total, "block int, sums binary")
    out = np.zeros((BUCKETS // BLOCK, BLOCK * SIZE), np.int64)
    for r in parts.collect():  # BUCKETS x SIZE numbers
        out[r.block] += np.frombuffer(r.sums, np.int64)
    return out.reshape(BUCKETS, SIZE)


def word_vectors(sums: np.ndarray) -> np.ndarray:
    """Word vectors of all buckets from the sums of ``contexts``."""
    places, signs = index_vectors()
    own = np.zeros((BUCKETS, SIZE))
    np.put_along_axis(own, places, np.broadcast_to(signs, places.shape), axis=1)
    around = np.sign(sums) * np.log1p(np.abs(sums))  # a few neighbours everywhere must not hide the others
    unit = lambda x: x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    return (unit(own) + unit(around)).astype(np.float32)


def pooled(marks: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    if not len(marks):
        return np.zeros(SIZE, np.float32)
    buckets, n = np.unique(marks, return_counts=True)
    return np.sqrt(n / len(marks)).astype(np.float32) @ vectors[buckets]


@dataclass(frozen=True)
class Network:
    """Two layers; ``temperature`` divides what goes into the sigmoid."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -500, 500)))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 60, batch: int = 64, penalty: float = 1e-4) -> Network:
    """Mini-batches with Adam from fixed random weights. Without rows of both labels, the share of label 1 (or a half) is every score."""
    if not len(y) or y.min() == y.max():
        p = (y.sum() + 1) / (len(y) + 2)
        z = np.zeros
        return Network(z(SIZE), np.ones(SIZE), z((SIZE, 1)), z(1), z(1), float(np.log(p / (1 - p))))
    rng = np.random.default_rng(SEED)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = (x - mean) / scale
    w = [rng.normal(0, SIZE**-0.5, (SIZE, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    m, v, t = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w], 0
    for k in range(rounds):
        order = rng.permutation(len(y))
        rate = 0.003 * (1 - k / rounds) + 1e-5
        for at in range(0, len(y), batch):
            rows = order[at : at + batch]
            h = np.tanh(z[rows] @ w[0] + w[1])
            error = (1 / (1 + np.exp(-np.clip(h @ w[2] + w[3], -50, 50))) - y[rows]) / len(rows)
            back = np.outer(error, w[2]) * (1 - h * h)
            grads = [z[rows].T @ back + penalty * w[0], back.sum(axis=0), h.T @ error + penalty * w[2], error.sum(keepdims=True)]
            t += 1
            for j, g in enumerate(grads):
                m[j] = 0.9 * m[j] + 0.1 * g
                v[j] = 0.999 * v[j] + 0.001 * g * g
                w[j] = w[j] - rate * (m[j] / (1 - 0.9**t)) / (np.sqrt(v[j] / (1 - 0.999**t)) + 1e-8)
    return Network(mean, scale, w[0], w[1], w[2], float(w[3][0]))


def calibrated(net: Network, x: np.ndarray, y: np.ndarray) -> Network:
    """The network with the temperature (of 0.25 to 10) at which kept back labels are likeliest."""
    if not len(y):
        return net
    z = net.logits(x)
    loss = lambda t: np.logaddexp(0, np.where(y > 0, -z, z) / t).mean()
    return Network(net.mean, net.scale, net.w1, net.b1, net.w2, net.b2, float(min(np.geomspace(0.25, 10, 150), key=loss)))


def labelled(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, most: int) -> DataFrame:
    """(text, y, back): at most ``most`` distinct texts whose label may be learned, chosen by a hash; back: kept back for the temperature."""
    known = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1)).where(learnable(key)).groupBy(F.col(key).cast("long").alias(key)).agg(F.max(label).cast("double").alias("y"))
    texts = docs.select(key, F.xxhash64(text).alias("h")).distinct().join(known, key)
    texts = written(texts.select(key, "h", "y", F.xxhash64(key, "h", F.lit(SEED)).alias("lot")), "labelled")
    n = texts.count()
    if n > most:  # first about ``most`` rows by a threshold, so that few are sorted
        texts = texts.where(F.pmod("lot", F.lit(1 << 30)) < int((1 << 30) * min(1.0, 1.2 * most / n)))
    chosen = F.broadcast(texts.orderBy("lot", key, "h").limit(most))  # at most ``most`` rows
    found = docs.withColumn("h", F.xxhash64(text)).join(chosen, [key, "h"])
    once = found.groupBy(key, "h").agg(F.first(text).alias("text"), F.first("y").alias("y"), F.first("lot").alias("lot"))
    return once.select("text", "y", (F.pmod("lot", F.lit(5)) == 0).alias("back"))


def scores(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", fit_rows: int = FIT_ROWS) -> DataFrame:
    """Per row: key, held_out (its label may not be learned), score (0 to 1), predicted (1 if score >= 0.5).

    Null texts are empty; empty ones get the network's score of a zero vector. Labels other than 0 and 1,
    of null or unknown keys, or of held out rows are left aside, of several of a key the largest
    holds. Rows with a null key are scored, and never learned from. Repeated rows come out repeatedly and are learned
    once; with labels of one kind only, all scores are alike; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    importable(spark)
    rows = text_rows(docs, key, text)
    vectors = spark.sparkContext.broadcast(word_vectors(contexts(rows.select(text))))

    def vector(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Marks()
        for batch in batches:
            x = [pooled(reader.of(t.as_py()), vectors.value).tobytes() for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()), batch.column(1), batch.column(2)], names=["x", "y", "back"])

    known = labelled(rows, labels, key, text, label, fit_rows).mapInArrow(vector, "x binary, y double, back boolean").collect()  # at most fit_rows rows
    known.sort(key=lambda r: r.x)
    x, y, back = np.array([np.frombuffer(r.x, np.float32) for r in known], float).reshape(-1, SIZE), np.array([r.y for r in known]), np.array([r.back for r in known], bool)
    net = spark.sparkContext.broadcast(calibrated(fit(x[~back], y[~back]), x[back], y[back]))

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Marks()
        for batch in batches:
            x = [pooled(reader.of(t.as_py()), vectors.value) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(net.value.scores(np.array(x).reshape(-1, SIZE)))], names=[key, "score"])

    scored = rows.mapInArrow(score, f"{key} long, score double")
    return scored.select(key, (~learnable(key)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
