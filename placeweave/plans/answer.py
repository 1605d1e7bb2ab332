"""From queries to judged result pages."""

from __future__ import annotations

from pyspark.sql import DataFrame

from placeweave.operators.evaluate import judge_hits, ndcg
from placeweave.operators.inverted import Index
from placeweave.operators.search import search


def answer(queries: DataFrame, index: Index, synonyms: DataFrame | None = None) -> DataFrame:
    return search(queries, index, synonyms)


def quality(pages: DataFrame, judgments: DataFrame) -> DataFrame:
    """NDCG of result pages (query_id, rank, title) against judgments."""
    return ndcg(judge_hits(pages, judgments))
