"""A cleaning pipeline over documents: each stage applies one operator and its decisions take effect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeweave.llm import decontamination, packing, pii, simhash, toxicity
from placeweave.llm.common import written
from placeweave.llm.queries import RANKS, VOCABULARY

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out documents predicted to be toxic, each row by its own text.

    Null and empty texts stay unless the model finds a text without words toxic; repeated rows, rows without
    doc_id and other columns don't matter; an empty table gives an empty one.
    """
    scored = toxicity.scores(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), carry=COLUMNS)
    return scored.where("predicted = 0").select("carried.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near copies (fingerprints of 3-word shingles linked at 3 bits): that with the smallest doc_id, null last.

    Texts without words, null and empty ones included, are one group; repeated rows become one; an empty table gives an empty one.
    """
    return simhash.one_of_each(docs.select(COLUMNS))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out rows whose text holds a window of a benchmark item; texts without words stay, repeated rows too; an empty table gives an empty one."""
    return decontamination.clean(docs.select(COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts kinds in place of personal data; n_chars is that of the new text.

    Every row stays: null texts are empty then, repeated rows come out repeatedly; an empty table gives an empty one.
    """
    return pii.redacted(docs).withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all texts into sequences of 1024 tokens; null texts are empty, each row is packed, whatever its doc_id; an empty table gives an empty one."""
    return packing.pack_documents(docs, VOCABULARY, RANKS, end_id=2, capacity=1024)


STAGES = [("toxicity", drop_toxic), ("near copies", drop_near_copies), ("decontamination", drop_contaminated), ("personal data", redact), ("packing", pack)]

#: Scores, hashes and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written and read again; an empty table gives an empty one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
