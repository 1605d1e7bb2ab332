"""Token ids and token counts of whole texts, by a table of frequent pre-tokens and worker caches.

A piece is what stands between two single spaces. No pre-token of a byte-level vocabulary
reaches over the place before a single space between two other characters, so a text's ids
are the ids of its pieces, one after the other.

Counts look pre-tokens up twice: in a broadcast table with the number of tokens of those that are
frequent in a sample of the texts, then in a cache of the Python worker, which all its tasks share. Only
what is in neither is encoded, so no pre-token of the corpus is shuffled. Ids are cached by piece.
"""

from __future__ import annotations

import re
import uuid
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeweave.llm.common import importable, text_rows, worker_store

#: Pieces that a worker remembers, and their letters, in each of two generations.
CACHE_PIECES, CACHE_LETTERS = 400_000, 8_000_000
#: Rows of the sample in which frequent pre-tokens are looked for, and how many the table has. They only save work.
SAMPLE_ROWS, TABLE = 20_000, 50_000
#: Characters of a text that are cut into pieces at once, so that long texts need no more memory.
SLICE_CHARS = 1 << 20
#: Plain letters, digits and marks: both libraries split these alike whatever their Unicode version.
PLAIN = re.compile("[\t\n\r\x20-\x7eÀ-ɏ]*")
SPECIAL = "<|endoftext|>"
#: Before a single space between two other characters, where no pre-token goes on.
BREAK = re.compile(r"(?<=\S)(?= \S)")

def slices(text: str, size: int = SLICE_CHARS) -> Iterator[str]:
    """Cuts a long text before single spaces between two other characters."""
    start = 0
    while len(text) - start > size:
        at = start + size
        while (at := text.find(" ", at)) > 0 and (text[at - 1].isspace() or text[at + 1 : at + 2].isspace() or at + 1 == len(text)):
            at += 1
        if at < 0:
            break
        yield text[start:at]
        start = at
    yield text[start:]


class _Odd(Exception):
    """A piece at a place where more than one white space stands."""


class _Pieces(dict):
    """Ids by piece (without its space) in two generations of a cache, bounded by their number and letters."""

    def __init__(self, encode, size: int, letters: int = CACHE_LETTERS):
        super().__init__()
        self.encode, self.size, self.most, self.old, self.misses, self.letters = encode, size, letters, {}, 0, 0
        self.tails = {c: encode(c) for c in ".,;:!?"}  # a pre-token of their own after a letter or digit

    def __missing__(self, piece: str) -> bytes:
        if (ids := self.old.get(piece)) is None:
            if not piece or piece[0].isspace() or piece[-1].isspace():
                raise _Odd
            if piece[-1] in self.tails and piece[-2:-1].isalnum() and piece[-2] <= "\u024f":
                ids = self[piece[:-1]] + self.tails[piece[-1]]
            else:
                ids = self.encode(" " + piece)
                self.misses += 1
        self.letters += len(piece)
        if len(self) >= self.size or self.letters > self.most:
            self.old, self.letters = (dict(self) if self.letters <= 2 * self.most else {}), len(piece)
            self.clear()
        self[piece] = ids
        return ids


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit numbers, as ``tokenizers`` gives them.

    Pieces of plain letters that the caches lack are encoded by ``tiktoken`` from the same
    vocabulary's ranks (``ranks``, a path), which is several times faster for short strings;
    all others, and special strings, by ``tokenizers``. Without ``ranks`` all are.
    """

    def __init__(self, vocabulary: str, ranks: str | None = None, size: int = CACHE_PIECES):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(vocabulary)
        self.plain = ranks and _from_ranks(ranks).encode_ordinary
        self.pieces = _Pieces(self._piece, size)

    @classmethod
    def of_worker(cls, vocabulary: str, ranks: str | None) -> "Encoder":
        own, key = worker_store("ids"), (vocabulary, ranks)
        if key not in own:
            own[key] = cls(vocabulary, ranks)
        return own[key]

    def encode(self, text: str) -> bytes:
        """By the library alone."""
        return array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        if self.plain and PLAIN.fullmatch(piece) and SPECIAL not in piece:
            return array("I", self.plain(piece)).tobytes()
        return self.encode(piece)

    def _slice(self, text: str) -> bytes:
        if not text.strip():
            return self.encode(text)
        lead = text[0] == " "
        head, *rest = (text[1:] if lead else text).split(" ")
        if lead:
            rest.insert(0, head)
        try:
            found = b"".join(map(self.pieces.__getitem__, rest))
        except _Odd:
            return self.encode(text)
        if lead:
            return found
        if not head or head[0].isspace() or head[-1].isspace():
            return self.encode(text)
        return self._piece(head) + found

    def ids(self, text: str) -> bytes:
        if len(text) <= SLICE_CHARS:
            return self._slice(text) if text else b""
        return b"".join(map(self._slice, slices(text)))


def _from_ranks(path: str):
    import base64

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@cache
def _pattern():
    import public_tokenizers
    import regex

    return regex.compile(public_tokenizers.PATTERN)


def pre_tokens(piece: str) -> list[str]:
    """Pre-tokens of plain text, as the vocabulary's pattern has them."""
    return _pattern().findall(piece)


class _Lengths(dict):
    """Numbers of tokens by pre-token: the frequent ones, then two generations of a cache, bounded by number and letters."""

    def __init__(self, encode, frequent: dict[str, int], size: int, letters: int):
        super().__init__(frequent)
        self.encode, self.frequent, self.size, self.most, self.old, self.misses, self.letters = encode, frequent, size, letters, {}, 0, 0

    def __missing__(self, token: str) -> int:
        if (n := self.old.get(token)) is None:
            n = len(self.encode(token)) // 4
            self.misses += 1
        if len(token) > self.most // 100:
            return n  # rare, and not worth its room
        self.letters += len(token)
        if len(self) >= len(self.frequent) + self.size or self.letters > self.most:
            self.old = {k: v for k, v in self.items() if k not in self.frequent}
            self.clear()
            self.update(self.frequent)
            self.letters = len(token)
        self[token] = n
        return n


class Lengths:
    """Token counts of texts, as ``tokenizers`` gives them: by pre-tokens where all are plain, else by the library."""

    def __init__(self, vocabulary: str, ranks: str | None, frequent: dict[str, int], size: int = CACHE_PIECES, letters: int = CACHE_LETTERS):
        self.encoder = Encoder(vocabulary, ranks, 0)
        self.known = _Lengths(self.encoder._piece, frequent, size, letters)
        self.others = _Lengths(self.encoder.encode, {}, size // 4, letters)

    @classmethod
    def of_worker(cls, vocabulary: str, ranks: str | None, table: str, frequent: dict[str, int]) -> "Lengths":
        """The worker's own for this table (named by ``table``); that of another one leaves."""
        own, key = worker_store("lengths"), (vocabulary, ranks, table)
        if key not in own:
            own.clear()
            own[key] = cls(vocabulary, ranks, frequent)
        return own[key]

    def _slice(self, text: str) -> int:
        if PLAIN.fullmatch(text) and SPECIAL not in text:
            return sum(map(self.known.__getitem__, pre_tokens(text)))
        if not text.strip():
            return len(self.encoder.encode(text)) // 4
        total, plain = 0, []
        for part in pieces_of(text):
            if PLAIN.fullmatch(part) and SPECIAL not in part:
                plain.append(part)
            else:
                total += self.others[part]
        return total + sum(self.known[t] for part in plain for t in pre_tokens(part))

    def count(self, text: str) -> int:
        return sum(self._slice(x) for x in slices(text) if x)


def pieces_of(text: str) -> list[str]:
    """Cuts a text before single spaces between two other characters; the pieces joined are the text."""
    return BREAK.split(text)


def frequent_lengths(rows: DataFrame, vocabulary: str, ranks: str | None, text: str = "text", sample: int = SAMPLE_ROWS, most: int = TABLE) -> dict[str, int]:
    """Numbers of tokens of the ``most`` pre-tokens that are most frequent in about ``sample`` rows, chosen by a hash of their text."""
    n = rows.count()
    part = rows.select(text).where(F.pmod(F.xxhash64(text), F.lit(1 << 30)) < int((1 << 30) * min(1.0, sample / max(n, 1))))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for x in batch.column(0):
                for part in slices(x.as_py()):
                    found.update(t for p in pieces_of(part) if PLAIN.fullmatch(p) for t in pre_tokens(p) if len(t) < 64)
                if len(found) > 4 * most:
                    found = Counter({k: v for k, v in found.items() if v > 1})
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["token", "n"])

    counts = part.mapInArrow(count, "token string, n long").groupBy("token").agg(F.sum("n").alias("n")).where("n > 1")
    top = [r.token for r in counts.orderBy(F.desc("n"), "token").limit(most).collect()]  # ``most`` rows
    encoder = Encoder(vocabulary, ranks, 0)
    return {t: len(encoder._piece(t)) // 4 for t in top if SPECIAL not in t}


def count_tokens(docs: DataFrame, vocabulary: str, ranks: str | None = None, limit: int = 512, key: str = "doc_id", text: str = "text", sample: int = SAMPLE_ROWS) -> DataFrame:
    """Per row: key, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    A null text counts as empty (0 tokens); a null key stays null; repeated rows come out
    repeatedly; an empty table gives an empty one; other columns are not looked at.
    """
    spark = docs.sparkSession
    importable(spark)
    rows = text_rows(docs, key, text)
    table = frequent_lengths(rows, vocabulary, ranks, text, sample)
    name, frequent = uuid.uuid4().hex, spark.sparkContext.broadcast(table)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = Lengths.of_worker(vocabulary, ranks, name, frequent.value)
        for batch in batches:
            n = pa.array([lengths.count(x.as_py()) for x in batch.column(1)], pa.int64())
            size = pa.compute.binary_length(batch.column(1)).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), size, n, pa.compute.greater(n, limit)], names=[key, "n_bytes", "n_tokens", "over_limit"])

    return rows.mapInArrow(count, f"{key} long, n_bytes long, n_tokens long, over_limit boolean")


def encoded(docs: DataFrame, vocabulary: str, ranks: str | None, per_row, schema: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Applies ``per_row(key, ids) -> rows`` (tuples of ``schema``) to each row's ids."""
    importable(docs.sparkSession)
    import pyspark.sql.types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    out = to_arrow_schema(T.StructType.fromDDL(schema))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of_worker(vocabulary, ranks)
        for batch in batches:
            rows = [r for k, x in zip(batch.column(0).to_pylist(), batch.column(1)) for r in per_row(k, encoder.ids(x.as_py()))]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(out), out)], schema=out)

    return text_rows(docs, key, text).mapInArrow(work, schema)
