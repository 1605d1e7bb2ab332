"""Pieces of HTML pages as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from placeweave import fixed
from placeweave.functions.text import blank_to_null, strip


def strip_tags(c: Column) -> Column:
    return strip(F.regexp_replace(c, fixed.TAG, ""))


def one_line(c: Column) -> Column:
    return F.replace(c, F.lit("\n"), F.lit(" "))


def without_fragment_marks(c: Column) -> Column:
    for mark in fixed.FRAGMENT_MARKS:
        c = F.replace(c, F.lit(mark), F.lit(""))
    return c


def first_match(c: Column, pattern: str, group: int = 1) -> Column:
    """Group of the first match, null (not empty) without one."""
    return blank_to_null(F.regexp_extract(c, pattern, group))


def every_match(c: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(group))


def absolute_url(href: Column, host: str) -> Column:
    """A path gets the host in front; a full address stays, an empty one is null."""
    return F.when(href.startswith("http"), href).when(href != "", F.concat(F.lit(host), href))


def slug(c: Column) -> Column:
    return F.replace(F.lower(strip_tags(c)), F.lit(" "), F.lit("_"))


def price_text(card: Column) -> Column:
    """Amounts and price labels of the price block in page order."""
    block = first_match(card, fixed.PRICE_BLOCK)
    pieces = F.zip_with(
        every_match(block, fixed.PRICE_PIECE, 1), every_match(block, fixed.PRICE_PIECE, 2), lambda amount, label: F.concat_ws("", amount, label)
    )
    return strip(F.array_join(F.filter(pieces, lambda p: p != ""), " "))


def list_items(section: Column) -> Column:
    """Texts of the non-blank list items; null without any."""
    items = F.filter(every_match(section, fixed.LIST_ITEM), lambda i: strip(i) != "")
    texts = F.transform(items, strip_tags)
    return F.when(F.size(texts) > 0, texts)


def featured_reviews(page: Column) -> Column:
    """The first two review texts, of which blank ones are dropped."""
    first_two = F.slice(every_match(without_fragment_marks(one_line(page)), fixed.REVIEW), 1, 2)
    return F.filter(F.transform(first_two, strip_tags), lambda r: r != "")


def product_block(page: Column) -> Column:
    """The first JSON-LD block that describes a product or an attraction."""
    return F.get(F.filter(every_match(page, fixed.LD_BLOCK), lambda b: b.rlike(fixed.LD_WANTED)), F.lit(0))


PRODUCT_SCHEMA = (
    "`@type` string, name string, description string, "
    "aggregateRating struct<ratingValue:string,reviewCount:string>, offers struct<price:string,priceCurrency:string>"
)


def product_json(page: Column) -> Column:
    """The product block parsed as JSON: stricter than patterns, null if it is no valid JSON."""
    return F.from_json(product_block(page), PRODUCT_SCHEMA)
