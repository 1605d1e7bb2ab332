"""Pages of a MediaWiki dump.

A dump is read as text whose records end with ``PAGE_END``, so that one file is split over many
tasks; inside a page that string can't occur, since its text is escaped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeweave.sources.schemas import WIKI_XML

PAGE_END = "</page>"
PAGE_BEGIN = r"<page(?:\s[^>]*)?>"


def title_and_text(raw: DataFrame) -> DataFrame:
    """Title and latest text; pages lacking either are left out."""
    return raw.select("title", F.col("revision.text").alias("text")).where("title <> '' AND text <> ''")


def parsed(records: DataFrame) -> DataFrame:
    """Pages out of records (value) that end where a page ends; what stands before a page is left out."""
    parts = F.split("value", PAGE_BEGIN)
    page = F.concat(F.lit("<page>"), F.element_at(parts, -1), F.lit(PAGE_END))
    found = records.where(F.col("value").rlike(PAGE_BEGIN))
    return found.select(F.from_xml(page, WIKI_XML, {"ignoreSurroundingSpaces": "false"}).alias("page")).select("page.*")


def raw_pages(spark: SparkSession, path: str) -> DataFrame:
    return parsed(spark.read.text(path, lineSep=PAGE_END))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return title_and_text(raw_pages(spark, path))


def write_pages(pages: DataFrame, path: str, mode: str = "error") -> None:
    """Pages (title, text) as a dump-shaped XML folder."""
    pages.select("title", F.struct("text").alias("revision")).write.format("xml").option("rowTag", "page").option(
        "rootTag", "mediawiki"
    ).mode(mode).save(path)
