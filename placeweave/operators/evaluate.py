"""Ranking quality: discounted gain and NDCG."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placeweave.operators.order import ranked


def judge_hits(hits: DataFrame, judgments: DataFrame) -> DataFrame:
    """Hits (query_id, rank, title) with their relevance; a hit nobody judged counts 0."""
    relevance = judgments.groupBy("query_id", "title").agg(F.max("relevance").alias("relevance"))
    return hits.join(relevance, ["query_id", "title"], "left").select(
        "query_id", "rank", "title", F.coalesce("relevance", F.lit(0.0)).alias("relevance")
    )


def ndcg(judged: DataFrame) -> DataFrame:
    """DCG, ideal DCG and NDCG in percent for each query; ranks count 1, 2, 3, ...

    The ideal rank of a hit is its place by relevance, which may be any number, among the hits of its query;
    hits are sorted over all tasks, so those of one query need not fit into one.
    """
    discount = lambda rank: F.log2(F.col(rank) + 1)
    best_first = ranked(judged.select("query_id", "rank", "relevance"), "query_id", [F.desc("relevance")], "ideal")
    return (
        best_first.groupBy("query_id")
        .agg(
            F.count("*").alias("n_hits"),
            F.sum(F.col("relevance") / discount("rank")).alias("dcg"),
            F.sum(F.col("relevance") / discount("ideal")).alias("idcg"),
        )
        .withColumn("ndcg", F.when(F.col("idcg") > 0, 100 * F.col("dcg") / F.col("idcg")).otherwise(F.lit(0.0)))
    )
