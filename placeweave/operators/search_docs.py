"""Search documents out of enriched activities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType

from placeweave.functions.safe import rating_value, review_count
from placeweave.functions.text import blank_to_null
from placeweave.operators.linkage import match_facts, of_activities
from placeweave.operators.order import numbered


def flat_text(c: Column, kind: DataType) -> Column:
    """Any nested value as one text: parts joined by a space, null as nothing."""
    if isinstance(kind, ArrayType):
        parts = F.transform(c, lambda x: flat_text(x, kind.elementType))
        return F.coalesce(F.array_join(parts, " "), F.lit(""))
    if isinstance(kind, MapType):
        return flat_text(F.map_values(c), ArrayType(kind.valueType))
    if isinstance(kind, StructType):
        return F.concat_ws(" ", *[flat_text(c[f.name], f.dataType) for f in kind.fields])
    return F.coalesce(c.cast("string"), F.lit(""))


def column_text(df: DataFrame, name: str) -> Column:
    return flat_text(F.col(name), df.schema[name].dataType)


def title_text() -> Column:
    return F.coalesce(blank_to_null(F.col("title")), F.col("name"), F.lit(""))


def enriched_field(name: str) -> Column:
    """Value of the primary match, else of the first match that has one, else empty."""
    others = F.filter(F.transform("matches", lambda m: m[name]), lambda v: v != "")
    return F.coalesce(blank_to_null(F.col(f"primary_match.{name}")), F.get(others, F.lit(0)), F.lit(""))


def city_text(first_city: Column | None = None) -> Column:
    """The activity's city, else the title of the first match that is a city; null without."""
    if first_city is None:
        pages = F.filter("matches", lambda m: m["wiki_type"] == "city")
        first_city = F.get(pages, F.lit(0))["wiki_title"]
    return F.coalesce(blank_to_null(F.lower("city")), blank_to_null(F.lower(first_city)))


def document_numbers(activities: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(url, digest, doc_id): a number for each distinct row, digest being that of the whole row.

    Rows in ``known`` (an earlier result) keep their number, so ids are stable over rebuilds; new
    ones are numbered on, by url. Numbers are dense, and the same however the table is partitioned.
    """
    rows = activities.select("url", row_digest(activities).alias("digest")).distinct()
    if known is None:
        return numbered(rows, ["url", "digest"], "doc_id")
    new = rows.join(known, rows.url.eqNullSafe(known.url) & (rows.digest == known.digest), "left_anti")
    last = known.agg(F.coalesce(F.max("doc_id"), F.lit(-1))).first()[0]
    added = numbered(new, ["url", "digest"], "doc_id").withColumn("doc_id", F.col("doc_id") + F.lit(last + 1))
    return known.select("url", "digest", "doc_id").unionByName(added)


def row_digest(df: DataFrame) -> Column:
    return F.sha2(F.to_json(F.struct(*sorted(df.columns))), 256)


def _shown_and_searched(rows: DataFrame, doc_id: Column, architect: Column, style: Column, city: Column) -> DataFrame:
    texts = [column_text(rows, c) for c in ("description", "highlights", "featured_reviews")]
    return rows.withColumns({"_architect": architect, "_style": style}).select(
        "*",
        doc_id.alias("_doc_id"),
        title_text().alias("_title"),
        F.concat_ws(" ", *texts, "_architect", "_style").alias("_click_text"),
        city.alias("_city"),
    ).select(
        F.col("_doc_id").alias("doc_id"),
        F.col("_title").alias("title"),
        F.col("_click_text").alias("click_text"),
        *(["matches"] if "matches" in rows.columns else []),
        F.col("_city").alias("city"),
        "url",
        blank_to_null(F.col("_architect")).alias("architect"),
        blank_to_null(F.col("_style")).alias("style"),
        rating_value(F.col("rating")).alias("rating"),
        review_count(F.col("reviewCount"), isinstance(rows.schema["reviewCount"].dataType, StringType)).alias("review_count"),
    )


def search_documents(enriched: DataFrame, doc_id: Column | None = None) -> DataFrame:
    """Document rows of activities with nested matches: what is shown, what is searched and what ranks.

    Without ``doc_id`` the rows must have a column of that name (see ``document_numbers``).
    """
    number = F.col("doc_id") if doc_id is None else doc_id
    documents = _shown_and_searched(enriched, number, enriched_field("wiki_architect"), enriched_field("wiki_style"), city_text())
    abstracts = F.filter(F.transform("matches", lambda m: m["wiki_abstract"]), lambda a: a != "")
    return documents.select(
        "doc_id", "title", "click_text", F.coalesce(F.array_join(abstracts, " "), F.lit("")).alias("wiki_text"),
        "city", "url", "architect", "style", "rating", "review_count",
    )


def linked_documents(activities: DataFrame, matches: DataFrame, numbers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents of activities and their ranked matches: (documents without ``wiki_text``, its pieces).

    The text of the matched pages isn't put together: an activity may have any number of them. Its pieces
    (doc_id, rank, wiki_text) go to the index as they are. Equal rows of ``activities`` are one document.
    """
    rows = _numbered_rows(activities, numbers)
    pieces = matches.where("wiki_abstract <> ''").join(rows.select("url", "doc_id"), "url")
    return _documents(rows, match_facts(matches)), pieces.select("doc_id", "rank", F.col("wiki_abstract").alias("wiki_text"))


def grouped_documents(
    activities: DataFrame, matches: DataFrame, owners: DataFrame, numbers: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The same of matches of groups of activities: (documents, pieces of each group, holders of the pieces: doc_id, group).

    Documents of a group have the same pieces, which are kept once, with the group in place of doc_id.
    """
    rows = _numbered_rows(activities, numbers)
    facts = of_activities(match_facts(matches), owners, "url")
    pieces = matches.where("wiki_abstract <> ''").select(F.col("url").alias("group"), "rank", F.col("wiki_abstract").alias("wiki_text"))
    holders = rows.select("doc_id", "url").join(owners.withColumnRenamed("crawler_url", "url"), "url").select("doc_id", "group")
    return _documents(rows, facts), pieces, holders


def _numbered_rows(activities: DataFrame, numbers: DataFrame) -> DataFrame:
    rows = activities.withColumn("digest", row_digest(activities)).dropDuplicates(["url", "digest"])
    same = rows.url.eqNullSafe(numbers.url) & (rows.digest == numbers.digest)
    return rows.join(numbers, same).drop(numbers.url, numbers.digest, rows.digest)


def _documents(rows: DataFrame, facts: DataFrame) -> DataFrame:
    known = rows.join(facts, rows.url == facts.url, "left").drop(facts.url)
    field = lambda n: F.coalesce(blank_to_null(F.col(f"primary_match.wiki_{n}")), F.col(f"first_{n}"), F.lit(""))
    return _shown_and_searched(known, F.col("doc_id"), field("architect"), field("style"), city_text(F.col("first_city")))
