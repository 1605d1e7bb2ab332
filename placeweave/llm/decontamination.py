"""Benchmark decontamination by a prefix-filtered join, with DataFrame functions only.

A window is ``width`` consecutive words of a benchmark item; a shorter item is one window. A text
that holds a window holds each of its words, so looking up one word of a window is enough, and the
best one is that which is rarest in the texts (ties: the smaller word). Texts are searched for
those words; each find proposes the windows whose rarest word it is, at the one start that would
put it in its place. The start must not lie before the text and the end not after it; then the
words of the window are compared with those around the find.

The rarest words are a literal set in the scan, in blocks of PREFIX_WORDS: each further block of a
large benchmark is one more pass over the texts. All else is joined by key.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeweave.llm.common import written

WIDTH, PREFIX_WORDS = 10, 20_000
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column | str) -> Column:
    """Words of a text, A-Z lower-cased; none for null."""
    lower = F.translate(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lower, BETWEEN), "")


def windows(items: DataFrame, width: int, key: str = "item_id", text: str = "text") -> DataFrame:
    """(item, window): each distinct window of each item; items without words have none."""
    found = items.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("item"), words(text).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - width + 1, F.lit(1)))
    return found.select("item", F.explode(F.transform(starts, lambda s: F.slice("w", s, width))).alias("window")).distinct()


def rarity(docs: DataFrame, wins: DataFrame, text: str) -> DataFrame:
    """(word, n): how often the words of windows occur in the texts; words that don't, 0."""
    own = written(wins.select(F.explode("window").alias("word")).distinct(), "window-words")
    counts = docs.select(F.explode(words(text)).alias("word")).join(own, "word", "left_semi").groupBy("word").agg(F.count("*").alias("n"))
    return own.join(counts, "word", "left").select("word", F.coalesce("n", F.lit(0)).alias("n"))


def prefixes(wins: DataFrame, counts: DataFrame) -> DataFrame:
    """(item, window, word, offset): the rarest word of each window and its first place in it; of windows whose words all occur."""
    rare = wins.select("item", "window", F.posexplode("window").alias("offset", "word")).join(counts, "word")
    best = F.min(F.struct("n", "word", "offset")).alias("best")
    return rare.groupBy("item", "window").agg(best).where("best.n > 0").select("item", "window", "best.word", "best.offset")


def row_name(key: str, text: str) -> Column:
    """Tells rows apart by key and text, the same in every pass over them."""
    return F.concat_ws(":", F.col(key).cast("string"), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def finds(docs: DataFrame, prefix: list[str], width: int, key: str, text: str) -> DataFrame:
    """(row, key, n_words, found): the places of prefix words in each text, with the words around."""
    hit = F.array_compact(F.transform("w", lambda w, i: F.when(w.isin(prefix), i)))

    def around(at: Column) -> Column:
        first = F.greatest(at - (width - 1), F.lit(0))
        return F.struct(at.alias("at"), F.element_at("w", at + 1).alias("word"), first.alias("first"), F.slice("w", first + 1, at - first + width).alias("context"))

    rows = docs.select(row_name(key, text).alias("row"), F.col(key).cast("long").alias(key), words(text).alias("w"))
    return rows.select("row", key, F.size("w").alias("n_words"), F.transform(hit, around).alias("found"))


def occurrences(found: DataFrame, prefix: DataFrame) -> DataFrame:
    """(row, start, size, item) of every window that is in a text."""
    spots = found.where(F.size("found") > 0).select("row", "n_words", F.inline("found")).join(prefix, "word")
    start = F.col("at") - F.col("offset")
    size = F.size("window")
    spots = spots.withColumn("start", start).withColumn("size", size).where((F.col("start") >= 0) & (F.col("start") + F.col("size") <= F.col("n_words")))
    return spots.where(F.slice("context", F.col("start") - F.col("first") + 1, F.col("size")) == F.col("window")).select("row", "start", "size", "item")


def search(docs: DataFrame, items: DataFrame, width: int, key: str, text: str, item_key: str, prefix_words: int) -> tuple[DataFrame, DataFrame]:
    """(row, key, n_words) of all rows, and ``occurrences`` in them."""
    wins = written(windows(items, width, item_key), "windows")
    prefix = written(prefixes(wins, rarity(docs, wins, text)), "prefixes")
    n = prefix.select("word").distinct().count()
    blocks = -(-n // prefix_words) or 1
    passes = []
    for b in range(blocks):
        own = prefix.where(F.pmod(F.xxhash64("word"), F.lit(blocks)) == b)
        chosen = [r.word for r in own.select("word").distinct().collect()]  # about prefix_words
        found = written(finds(docs, chosen, width, key, text), "finds")
        passes.append((found, occurrences(found, own)))
    return passes[0][0].select("row", key, "n_words"), reduce(DataFrame.unionByName, [x for _, x in passes])


def clean(docs: DataFrame, items: DataFrame, width: int = WIDTH, key: str = "doc_id", text: str = "text", item_key: str = "item_id", prefix_words: int = PREFIX_WORDS) -> DataFrame:
    """Rows of docs that hold no window of an item, with all their columns.

    Each row is judged by its own text, whatever its key; without items all stay; an empty table gives an empty one.
    Spark sends the rows found to every task if their table is small, and else joins by row.
    """
    hit = written(search(docs, items, width, key, text, item_key, prefix_words)[1].select("row").distinct(), "hit-rows")
    return docs.join(hit, row_name(key, text) == hit.row, "left_anti")


def contamination(docs: DataFrame, items: DataFrame, width: int = WIDTH, key: str = "doc_id", text: str = "text", item_key: str = "item_id", prefix_words: int = PREFIX_WORDS) -> DataFrame:
    """Per row: key, n_words, n_hit (words inside any window), n_items, items_sha256, contaminated.

    Null texts and items have no words. Items are told apart by their key as a string, a null one
    being the empty string, and rows of the same key count once. Repeated rows and rows with a null
    key come out one by one; with no items nothing is contaminated; an empty table gives an empty one.
    """
    found, inside = search(docs, items, width, key, text, item_key, prefix_words)
    spans = F.transform(F.collect_set(F.struct("start", "size")), lambda x: F.sequence(x.start, x.start + x.size - 1))
    each = inside.groupBy("row").agg(F.size(F.array_distinct(F.flatten(spans))).alias("hit"), F.sort_array(F.collect_set("item")).alias("items"))
    out = found.join(each, "row", "left")
    return out.select(
        key, F.col("n_words").cast("long").alias("n_words"), F.coalesce("hit", F.lit(0)).cast("long").alias("n_hit"),
        F.when(F.col("items").isNull(), 0).otherwise(F.size("items")).cast("long").alias("n_items"), F.sha2(F.coalesce(F.concat_ws(",", "items"), F.lit("")).cast("binary"), 256).alias("items_sha256"),
        F.col("hit").isNotNull().alias("contaminated"),
    )
