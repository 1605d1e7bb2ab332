"""Page records out of wikitext pages (title, text)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from placeweave import fixed
from placeweave.functions import markup as M
from placeweave.functions import text as T


def without_redirects(pages: DataFrame) -> DataFrame:
    return pages.where(~F.col("text").rlike(fixed.REDIRECT))


def with_categories(pages: DataFrame) -> DataFrame:
    """Adds ``categories``; a page in no category is left out."""
    return pages.withColumn("categories", M.categories(F.col("text"))).where(F.size("categories") > 0)


def page_url(title):
    return F.concat(F.lit(fixed.WIKI_BASE), F.replace(title, F.lit(" "), F.lit("_")))


def page_records(
    pages: DataFrame, infoboxes: list[str] | None = None, observation: Observation | None = None
) -> DataFrame:
    """Landmark records: everything a page says about itself, one narrow projection after the other."""
    kept = with_categories(without_redirects(pages))
    parsed = kept.select(
        "title",
        "categories",
        M.infobox_entries(M.infobox(F.col("text"), infoboxes)).alias("entries"),
        M.abstract(F.col("text")).alias("abstract"),
    ).withColumn("box", M.record_fields(F.col("entries")))
    located = parsed.withColumn(
        "fields",
        F.col("box").withField(
            "location",
            F.coalesce(
                F.col("box.location"),
                M.location_from_categories(F.col("categories")),
                M.location_from_abstract(F.col("abstract")),
            ),
        ),
    ).withColumn("geo_parent", M.geo_parents(F.col("fields.location"), F.col("categories")))
    records = located.select(
        "title",
        T.title_key(F.col("title")).alias("normalized"),
        T.title_tokens(F.col("title")).alias("tokens"),
        page_url(F.col("title")).alias("url"),
        "categories",
        "abstract",
        M.page_type(F.col("categories")).alias("type"),
        "fields",
        "geo_parent",
        F.transform("geo_parent", T.title_tokens).alias("geo_parent_tokens"),
    )
    return records.observe(observation, F.count("*").alias("records_kept")) if observation else records


def city_records(pages: DataFrame, infoboxes: list[str] | None = None) -> DataFrame:
    """Records of the pages whose infobox is one of a city."""
    names = fixed.CITY_INFOBOXES if infoboxes is None else infoboxes
    cities = pages.where(M.infobox_name(F.col("text")).isin(names))
    return page_records(cities, names).withColumn("type", F.lit("city"))


def infobox_counts(pages: DataFrame) -> DataFrame:
    named = pages.select(M.infobox_name(F.col("text")).alias("infobox")).where("infobox IS NOT NULL")
    return named.groupBy("infobox").agg(F.count("*").alias("n_pages"))


def top_infoboxes(pages: DataFrame, n: int = 50) -> DataFrame:
    """Most frequent infobox names with the number of distinct ones."""
    counts = infobox_counts(pages)
    return counts.orderBy(F.desc("n_pages"), "infobox").limit(n)


def distinct_infoboxes(pages: DataFrame) -> DataFrame:
    return infobox_counts(pages).agg(F.count("*").alias("n_infoboxes"))


def scan_counts(pages: DataFrame) -> DataFrame:
    """Pages scanned and records kept."""
    is_kept = ~F.col("text").rlike(fixed.REDIRECT) & (F.size(M.categories(F.col("text"))) > 0)
    return pages.agg(F.count("*").alias("pages_scanned"), F.count_if(is_kept).alias("records_kept"))


def observe_scan(pages: DataFrame, observation: Observation) -> DataFrame:
    """Counts the pages that pass by, without a scan of its own."""
    return pages.observe(observation, F.count("*").alias("pages_scanned"))
