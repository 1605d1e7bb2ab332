"""Terms within one or two edits of a token."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placeweave.functions.text import empty_strings

#: Keys of tokens that are sent to all tasks, which drop the keys of the vocabulary that no token has; beyond that, all are shuffled.
KEYS_AT_ONCE = 2_000_000
#: Keys that a task makes at once.
KEYS_IN_MEMORY = 4_000_000
# A key is the sum of a string's letters times powers of an odd number, modulo 2^64.
BASE, LETTER = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95


def with_keys(terms: DataFrame, name: str, k: int, wanted: np.ndarray | None = None) -> DataFrame:
    """Each row of ``terms`` for each string that its ``name`` is with up to ``k`` letters left out, with a hash of that as ``key``.

    Two terms within k insertions, deletions, replacements or swaps of neighbours always share one of these strings, which
    makes the search for near terms an equi-join. Only keys in ``wanted`` (ascending) are made, if it is given; a row may
    come with a key several times.
    """
    base, letter, at_once = BASE, LETTER, KEYS_IN_MEMORY

    def keys(letters):
        """(row, key) of strings of one length, given as a table of their letters."""
        rows, n = letters.shape
        back, twice_back = (np.uint64(pow(base, -i, 1 << 64)) for i in (1, 2))
        power = np.multiply.accumulate(np.r_[np.uint64(1), np.full(n, base, np.uint64)])[:n]
        step = max(1, at_once // (1 + n * n))
        for start in range(0, rows, step):
            worth = (letters[start : start + step].astype(np.uint64) + np.uint64(1)) * np.uint64(letter)
            worth ^= worth >> np.uint64(29)
            own = np.arange(start, start + len(worth))
            upto = np.concatenate([np.zeros((len(own), 1), np.uint64), np.cumsum(worth * power, axis=1, dtype=np.uint64)], axis=1)
            whole = upto[:, -1:]
            yield own, whole.ravel()
            yield np.repeat(own, n), (upto[:, :-1] + back * (whole - upto[:, 1:])).ravel()
            for i in range(n - 1 if k == 2 else 0):  # without letter i and a later one
                between, after = upto[:, i + 1 : -1] - upto[:, i + 1 : i + 2], whole - upto[:, i + 2 :]
                yield np.repeat(own, n - 1 - i), (upto[:, i : i + 1] + back * between + twice_back * after).ravel()

    def work(batches):
        for batch in batches:
            texts = np.array(batch.column(name).to_pylist(), object)
            lengths = np.array([-1 if t is None else len(t) for t in texts], np.int64)
            for n in np.unique(lengths[lengths >= 0]).tolist():
                of_length = np.flatnonzero(lengths == n)
                letters = np.array([ord(c) for t in texts[of_length] for c in t], np.uint32).reshape(len(of_length), n)
                for row, key in keys(letters):
                    key = key.view(np.int64)
                    if wanted is not None:
                        at = np.minimum(np.searchsorted(wanted, key), len(wanted) - 1)
                        there = wanted[at] == key if len(wanted) else np.zeros(len(key), bool)
                        row, key = row[there], key[there]
                    if len(row):
                        yield pa.RecordBatch.from_arrays([*batch.take(pa.array(of_length[row])).columns, pa.array(key)], names=[*batch.schema.names, "key"])

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in terms.schema]
    return terms.mapInArrow(work, ", ".join([*kept, "key long"]))


def _swaps(t: Column) -> Column:
    swapped = F.transform(
        F.sequence(F.lit(1), F.length(t) - 1),
        lambda i: F.concat(
            F.substr(t, F.lit(1), i - 1), F.substr(t, i + 1, F.lit(1)), F.substr(t, i, F.lit(1)), F.substr(t, i + 2)
        ),
    )
    return F.when(F.length(t) > 1, swapped).otherwise(empty_strings())


def edits(a: Column, b: Column, k: int) -> Column:
    """Number of edits (0, 1 or 2), a swap of neighbours being one; null beyond ``k``."""
    within_one = (F.levenshtein(a, b, 1) >= 0) | F.array_contains(_swaps(a), b)
    out = F.when(a == b, 0).when(within_one, 1)
    if k == 2:
        near_swap = F.exists(_swaps(a), lambda s: F.levenshtein(s, b, 1) >= 0) | F.exists(
            _swaps(b), lambda s: F.levenshtein(s, a, 1) >= 0
        )
        within_two = (F.levenshtein(a, b, 2) >= 0) | near_swap | F.arrays_overlap(_swaps(a), _swaps(b))
        out = out.when(within_two, 2)
    return out


def near_terms(tokens: DataFrame, vocabulary: DataFrame, k: int) -> DataFrame:
    """All vocabulary terms (field, term, df) within ``k`` edits of each distinct token."""
    asked = tokens.select("token").distinct()
    # One row per length that can match: at most as many as the longest token has letters.
    lengths = asked.select(
        F.explode(F.sequence(F.greatest(F.length("token") - k, F.lit(1)), F.length("token") + k)).alias("n")
    ).distinct()
    reachable = vocabulary.withColumn("n", F.length("term")).join(F.broadcast(lengths), "n", "left_semi")
    left = with_keys(asked, "token", k)
    keys = left.select("key").distinct().limit(KEYS_AT_ONCE + 1).toArrow()["key"].to_numpy()
    wanted = np.sort(keys) if len(keys) <= KEYS_AT_ONCE else None
    right = with_keys(reachable.select("field", "term", "df"), "term", k, wanted)
    candidates = left.join(right, "key").select("token", "field", "term", "df").distinct()
    return candidates.withColumn("edits", edits(F.col("token"), F.col("term"), k)).where("edits IS NOT NULL")


def expansions(tokens: DataFrame, vocabulary: DataFrame, k: int, most: int | None = None) -> DataFrame:
    """Near terms of each token and field with their weight: nearer terms weigh more.

    A fuzzy clause stands for all of them, or for the ``most`` best ones if given; all are scored
    with the largest document frequency among them.
    """
    near = near_terms(tokens, vocabulary, k).withColumn(
        "factor", 1 - F.col("edits") / F.least(F.length("token"), F.length("term"))
    )
    same = Window.partitionBy("token", "field")
    if most:
        best = same.orderBy(F.desc("factor"), "term")
        near = near.withColumn("place", F.row_number().over(best)).where(F.col("place") <= most).drop("place")
    return near.withColumn("clause_df", F.max("df").over(same))
