"""Activity records out of listing and detail pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeweave import fixed
from placeweave.functions import html as H
from placeweave.functions.safe import rating_value, review_count


def destination_links(pages: DataFrame, host: str) -> DataFrame:
    """Destinations a home page links to."""
    section = F.regexp_extract("html", fixed.DESTINATION_SECTION, 1)
    links = F.arrays_zip(
        H.every_match(section, fixed.DESTINATION_LINK, 1).alias("href"),
        H.every_match(section, fixed.DESTINATION_LINK, 2).alias("name"),
    )
    return pages.select("page_id", F.explode(links).alias("link")).select(
        "page_id", H.slug(F.col("link.name")).alias("city_name"), H.absolute_url(F.col("link.href"), host).alias("url")
    )


def without_skipped(destinations: DataFrame, skip: DataFrame) -> DataFrame:
    """Destinations that are not on the skip list, a table (city_name)."""
    return destinations.join(skip, "city_name", "left_anti")


def listing_cards(pages: DataFrame, host: str) -> DataFrame:
    """One row per activity card; the class pattern counts only where no card has the test id."""
    page = pages.select("page_id", H.without_fragment_marks(H.one_line(F.col("html"))).alias("html"))
    by_id = page.withColumn("cards", H.every_match(F.col("html"), fixed.CARD_BY_TEST_ID))
    cards = by_id.withColumn(
        "cards", F.when(F.size("cards") > 0, F.col("cards")).otherwise(H.every_match(F.col("html"), fixed.CARD_BY_CLASS))
    )
    card = F.col("card")
    return cards.select("page_id", F.posexplode("cards").alias("pos", "card")).select(
        "page_id",
        "pos",
        H.absolute_url(H.first_match(card, fixed.CARD_HREF), host).alias("url"),
        H.strip_tags(H.first_match(card, fixed.CARD_TITLE)).alias("title"),
        H.first_match(card, fixed.CARD_RATING).alias("rating"),
        F.replace(H.first_match(card, fixed.CARD_REVIEWS), F.lit(","), F.lit("")).alias("reviews"),
        H.price_text(card).alias("price"),
    )


def detail_records(pages: DataFrame) -> DataFrame:
    """What a detail page (url, html) says about its activity."""
    flat = pages.select("url", H.one_line(F.col("html")).alias("html"))
    block = F.col("block")
    return flat.withColumn("block", H.product_block(F.col("html"))).select(
        "url",
        H.strip_tags(H.first_match(F.col("html"), fixed.DETAIL_TITLE)).alias("title"),
        H.first_match(block, fixed.LD_TYPE).alias("ld_type"),
        H.first_match(block, fixed.LD_NAME).alias("name"),
        H.first_match(block, fixed.LD_DESCRIPTION).alias("description"),
        rating_value(H.first_match(block, fixed.LD_RATING)).alias("rating"),
        review_count(H.first_match(block, fixed.LD_REVIEWS)).alias("reviewCount"),
        H.first_match(block, fixed.LD_PRICE).alias("price"),
        H.first_match(block, fixed.LD_CURRENCY).alias("currency"),
        H.list_items(H.first_match(F.col("html"), fixed.HIGHLIGHTS)).alias("highlights"),
        H.featured_reviews(F.col("html")).alias("featured_reviews"),
    )


def overlay(cards: DataFrame, details: DataFrame) -> DataFrame:
    """Detail values over card values; a card without a detail page keeps its own."""
    d = details.select([F.col(c).alias("_" + c if c in ("title", "rating", "price") else c) for c in details.columns])
    return cards.join(d, "url", "left").select(
        "url",
        F.coalesce("_title", "title").alias("title"),
        "name", "description", "ld_type",
        F.coalesce("_rating", rating_value(F.col("rating"))).alias("rating"),
        review_count(F.col("reviews")).alias("reviews"),
        "reviewCount",
        F.coalesce("_price", "price").alias("price"),
        "currency", "highlights", "featured_reviews",
    )
