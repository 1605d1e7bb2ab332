"""From activities and pages to enriched activities and their search index."""

from __future__ import annotations

from pyspark.sql import DataFrame

from placeweave.operators import linkage
from placeweave.operators.inverted import Index, read_index, read_numbers, write_index
from placeweave.operators.places import backfill_city, with_place
from placeweave.operators.search_docs import document_numbers, grouped_documents, linked_documents


def place(activities: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Activities with their city filled in from the dictionary where it was blank; none is left out."""
    return backfill_city(activities, dictionary)


def link(
    activities: DataFrame, landmarks: DataFrame, cities: DataFrame | None, dictionary: DataFrame
) -> DataFrame:
    """Match pairs of activities with landmark and city pages."""
    return linked(activities, landmarks, cities, dictionary).rows().select(*linkage.V3_COLUMNS)


def linked(
    activities: DataFrame, landmarks: DataFrame, cities: DataFrame | None, dictionary: DataFrame
) -> linkage.Linked:
    """The same links between classes of rows."""
    placed = with_place(activities, dictionary)
    return linkage.linked_v3(placed, linkage.union_pages(landmarks, cities))


def matches(pairs: DataFrame, pages: DataFrame) -> DataFrame:
    """Ranked matches of each activity as a written table (url, rank, page fields)."""
    return linkage.written(linkage.ranked_matches(linkage.match_details(pairs, pages)), "matches")


def nest(pairs: DataFrame, pages: DataFrame) -> DataFrame:
    """Nested matches, one row per activity that has any."""
    return linkage.nest_matches(matches(pairs, pages))


def enrich(activities: DataFrame, pairs: DataFrame, pages: DataFrame) -> DataFrame:
    """Activities with their matches nested; those without a match stay, with none."""
    return activities.join(nest(pairs, pages), "url", "left")


def build_index(activities: DataFrame, ranked: DataFrame, path: str, owners: DataFrame | None = None) -> Index:
    """Index of activities (as ``place`` leaves them) and their ``matches``; rows indexed before keep their number.

    ``ranked`` may be the matches of groups of activities, ``owners`` then says which group an activity is in (``activity_groups``).
    """
    spark = activities.sparkSession
    numbers = linkage.written(document_numbers(activities, read_numbers(spark, path)), "numbers")
    if owners is None:
        documents, pieces = linked_documents(activities, ranked, numbers)
        write_index(documents, path, pieces=pieces, numbers=numbers)
    else:
        documents, pieces, holders = grouped_documents(activities, ranked, owners, numbers)
        write_index(documents, path, pieces=pieces, numbers=numbers, holders=holders)
    return read_index(spark, path)
