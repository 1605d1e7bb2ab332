"""Data-quality profile of pages and links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeweave.functions import text as T
from placeweave.operators.linkage import Linked, written
from placeweave.operators.skew import ROWS_PER_SLICE, hot_keys, split_hot_lookup


def page_profile(pages: DataFrame, geo_index: int = 0, short_title: int = 1) -> DataFrame:
    """Row, null, empty-key and short-title counts in one pass."""
    key = T.unicode_key(F.get("geo_parent", F.lit(geo_index)))
    return pages.agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("geo_parent").isNull()).alias("geo_null"),
        F.count_if(F.col("geo_parent").isNotNull()).alias("geo_not_null"),
        F.count_if(F.coalesce(key, F.lit("")) == "").alias("key_empty"),
        F.count_if(F.size(T.split_tokens(F.col("title"))) <= short_title).alias("title_short"),
    )


def key_preview(pages: DataFrame, geo_index: int = 0, n: int = 100) -> DataFrame:
    key = T.unicode_key(F.get("geo_parent", F.lit(geo_index)))
    return pages.select(key.alias("geo_key")).distinct().orderBy(F.col("geo_key").asc_nulls_first()).limit(n)


def short_titles(pages: DataFrame, max_tokens: int = 2, n: int = 20) -> DataFrame:
    few = pages.where(F.size(T.split_tokens(F.col("title"))) <= max_tokens)
    return few.select("title", "url").orderBy("title", "url").limit(n)


def sample_geo(pages: DataFrame, n: int = 10) -> DataFrame:
    return pages.select("title", "url", "geo_parent").orderBy("title", "url").limit(n)


def covered_rows(
    pages: DataFrame, activities: DataFrame, geo_index: int = 0, rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """Pages whose geo key is the city key of some activity."""
    keyed = pages.withColumn("geo_key", T.unicode_key(F.get("geo_parent", F.lit(geo_index))))
    cities = activities.select(T.unicode_key(F.col("city")).alias("geo_key")).distinct()
    hot = hot_keys(keyed.groupBy("geo_key").count(), ["geo_key"], rows_per_slice, "_ln")
    return split_hot_lookup(keyed, cities, ["geo_key"], ["url"], hot, "left_semi")


def key_coverage(pages: DataFrame, activities: DataFrame, geo_index: int = 0, n: int = 50) -> DataFrame:
    """Shared keys with the number of pages that have them, most frequent first.

    Pages are counted per key before they meet the cities, so a key that many pages share
    is one row by then.
    """
    counts = (
        pages.select(T.unicode_key(F.get("geo_parent", F.lit(geo_index))).alias("geo_key"))
        .groupBy("geo_key")
        .agg(F.count("*").alias("n_pages"))
    )
    cities = activities.select(T.unicode_key(F.col("city")).alias("geo_key")).distinct()
    return counts.join(cities, "geo_key", "left_semi").orderBy(F.desc("n_pages"), "geo_key").limit(n)


def coverage_totals(pages: DataFrame, activities: DataFrame, geo_index: int = 0) -> DataFrame:
    counts = (
        pages.select(T.unicode_key(F.get("geo_parent", F.lit(geo_index))).alias("geo_key"))
        .groupBy("geo_key")
        .agg(F.count("*").alias("n_pages"))
    )
    cities = activities.select(T.unicode_key(F.col("city")).alias("geo_key")).distinct()
    shared = counts.join(cities, "geo_key", "left_semi")
    return shared.agg(
        F.coalesce(F.sum("n_pages"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_keys")
    )


def link_stats(pairs: DataFrame) -> DataFrame:
    """Pairs by match type and distinct records matched on each side."""
    return pairs.agg(
        F.count("*").alias("n_pairs"),
        F.count_if(F.col("match_type") == "landmark").alias("n_landmark"),
        F.count_if(F.col("match_type") == "city_page").alias("n_city_page"),
        F.count_distinct("crawler_url").alias("n_activities"),
        F.count_distinct("wiki_url").alias("n_pages"),
    )


def class_link_stats(linked: Linked) -> DataFrame:
    """``link_stats`` of the rows that ``linked`` stands for: pairs are counted by classes, not built."""
    pairs = written(linked.pairs, "class_pairs")
    by_type = pairs.groupBy("match_type").agg(F.sum("n_pairs").alias("n"))

    def of(kind: str):
        return F.coalesce(F.sum(F.when(F.col("match_type") == kind, F.col("n"))), F.lit(0))

    counts = by_type.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_pairs"), of("landmark").alias("n_landmark"), of("city_page").alias("n_city_page"))
    matched = [
        rows.join(pairs.select(number).distinct(), number, "left_semi").agg(F.count_distinct(url).alias(name))
        for rows, number, url, name in ((linked.activities, "c", "crawler_url", "n_activities"), (linked.pages, "w", "wiki_url", "n_pages"))
    ]
    one = F.lit(1).alias("one")
    rows = [df.select("*", one) for df in (counts, *matched)]  # one row each
    return rows[0].join(rows[1], "one").join(rows[2], "one").drop("one")


def distinct_matched(pairs: DataFrame, exact: bool = True) -> DataFrame:
    count = F.count_distinct if exact else F.approx_count_distinct
    return pairs.agg(
        F.count("*").alias("n_pairs"),
        count("crawler_url").alias("n_activities"),
        count("wiki_url").alias("n_pages"),
    )
