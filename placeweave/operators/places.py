"""Finding a place of the dictionary in a name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeweave.functions import text as T
from placeweave.operators.skew import ROWS_PER_SLICE, hot_keys, split_hot_lookup


def _lookup_words(dictionary: DataFrame) -> DataFrame:
    """Each phrase with its most telling word: the one fewest phrases contain.

    A phrase can only match a name that contains this word, so the word is an equi-join key.
    A phrase without any letter or digit has no such word and names no place.
    """
    words = dictionary.select(
        "pos", "phrase", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("phrase"), F.lit(T.WORD), F.lit(0)))).alias("word")
    )
    frequency = words.groupBy("word").agg(F.count("*").alias("n"))
    return (
        words.join(frequency, "word")
        .groupBy("pos", "phrase")
        .agg(F.min(F.struct("n", "word")).alias("rarest"))
        .select("pos", "phrase", F.col("rarest.word").alias("word"))
    )


def _as_pattern(phrase):
    quoted = F.replace(phrase, F.lit(r"\E"), F.lit(r"\E\\E\Q"))
    return F.concat(F.lit(r"(?U)\b\Q"), quoted, F.lit(r"\E\b"))


def backfill_city(activities: DataFrame, dictionary: DataFrame, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Fill a blank ``city`` with the first dictionary phrase (by ``pos``) found in ``name``.

    A given city is lower-cased.  Only rows with a blank city take part in the lookup, once
    per distinct name.
    """
    given = T.strip(F.col("city")) != ""
    blank = activities.where(~F.coalesce(given, F.lit(False)))
    names = blank.where("name IS NOT NULL").groupBy("name").count()
    found = (
        names.withColumn("word", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("name"), F.lit(T.WORD), F.lit(0)))))
        .join(_lookup_words(dictionary), "word")
        .where(F.rlike(F.lower("name"), _as_pattern(F.col("phrase"))))
        .groupBy("name")
        .agg(F.min("pos").alias("pos"))
        .join(dictionary.select("pos", "phrase"), "pos")
        .select("name", F.col("phrase").alias("found_city"))
    )
    hot = hot_keys(names, ["name"], rows_per_slice, "_ln")
    filled = split_hot_lookup(blank, found, ["name"], ["url"], hot).withColumn("city", F.col("found_city"))
    kept = activities.where(given).withColumn("city", F.lower("city"))
    return kept.select(*activities.columns).unionByName(filled.select(*activities.columns))


def with_place(activities: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Backfilled activities with a usable city key; rows without a place are left out."""
    filled = backfill_city(activities, dictionary).withColumn("city_norm", T.unicode_key(F.col("city")))
    return filled.where("city_norm <> ''")
