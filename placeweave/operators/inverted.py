"""Inverted index as tables.

``documents``    texts as they are searched, what a hit shows and what ranks it
``postings``     field, term, doc_id, tf, dl (length of the field in the document), positions, bucket
``term_stats``   field, term, df, bucket
``field_stats``  field, n_docs, avgdl
``versions``     one row for each complete build of these: number, folder, buckets

A build writes a folder of its own and adds its row to ``versions`` last, so readers see whole
indexes only, and one that was opened stays as it is while others are built.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from placeweave.functions.text import ANALYSED_WORD, analysed_terms, bind

TEXT_FIELDS = ["title", "click_text", "wiki_text"]
ALL_FIELDS = [*TEXT_FIELDS, "city"]
SHOWN = ["doc_id", "title", "city", "url", "architect", "style", "rating", "review_count"]
# Buckets of terms: one for so many documents, within these bounds.
DOCS_PER_BUCKET, LEAST_BUCKETS, MOST_BUCKETS = 5_000, 16, 4096
# Terms of texts that are counted together in a task.
TERMS_AT_ONCE = 500_000


@dataclass
class Index:
    docs: DataFrame
    postings: DataFrame
    term_stats: DataFrame
    field_stats: DataFrame
    buckets: int | None = None  # of the terms in a written index

    def with_bucket(self, terms: DataFrame) -> DataFrame:
        """A table with ``term`` and the bucket that a written index keeps it in, for joins that read no other."""
        return terms if self.buckets is None else terms.withColumn("bucket", bucket_of(F.col("term"), self.buckets))

    @property
    def term_keys(self) -> list[str]:
        return ["field", "term"] if self.buckets is None else ["field", "bucket", "term"]


def bucket_of(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def field_terms(documents: DataFrame, split_city: bool = False, only: list[str] | None = None) -> DataFrame:
    """Terms of each field of a document in text order, and the field's length; an empty field has no row.

    The city is one term as it stands, or its words with ``split_city``.
    """
    city = analysed_terms(F.col("city")) if split_city else F.filter(F.array("city"), lambda c: c != "")
    terms = {f: analysed_terms(F.col(f)) for f in TEXT_FIELDS if f in documents.columns} | {"city": city}
    fields = [F.struct(F.lit(f).alias("field"), t.alias("terms")) for f, t in terms.items() if only is None or f in only]
    rows = documents.select("doc_id", F.inline(F.array(*fields))).where(F.size("terms") > 0)
    return rows.select("doc_id", "field", "terms", F.size("terms").alias("dl"))


def counted_terms(terms: Column, with_positions: Column) -> Column:
    """Each distinct term of a list with its number (``tf``) and its ascending places, where they are wanted.

    Terms are sorted with their places, and a run of equal ones is a term. ``counted_rows`` does the same for tables, faster.
    """
    placed = F.array_sort(F.transform(terms, lambda t, i: F.struct(t.alias("term"), i.alias("pos"))))

    def runs(sorted_terms: Column) -> Column:
        begins = F.filter(
            F.sequence(F.lit(0), F.size(sorted_terms) - 1),
            lambda i: (i == 0) | (F.get(sorted_terms, i)["term"] != F.get(sorted_terms, i - 1)["term"]),
        )
        return bind(begins, lambda starts: F.transform(starts, lambda at, k: run(sorted_terms, starts, at, k)))

    def run(sorted_terms: Column, starts: Column, at: Column, k: Column) -> Column:
        tf = F.coalesce(F.get(starts, k + 1), F.size(sorted_terms)) - at
        places = F.when(with_positions, F.transform(F.slice(sorted_terms, at + 1, tf), lambda p: p["pos"]))
        return F.struct(F.get(sorted_terms, at)["term"].alias("term"), tf.alias("tf"), places.alias("positions"))

    return bind(placed, runs)


def counted_rows(rows: DataFrame, with_positions: Column) -> DataFrame:
    """For each row, each distinct term of its ``terms`` with its number (``tf``) and its ascending places, where they are wanted.

    ``terms`` gives way to term, tf and positions. Texts that lie next to each other are counted together; no row leaves its task.
    """
    kept = [f for f in rows.schema if f.name != "terms"]
    names = [f.name for f in kept]
    at_once = TERMS_AT_ONCE

    def work(batches):
        import numpy as np
        import pyarrow as pa

        for whole in batches:
            ends = np.cumsum(whole.column("terms").value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
            cuts = np.flatnonzero(np.diff(ends // at_once)) + 1
            for start, end in zip([0, *cuts], [*cuts, whole.num_rows]):
                batch = whole.slice(start, end - start)
                lengths = batch.column("terms").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                row = np.repeat(np.arange(len(lengths)), lengths)
                place = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
                coded = batch.column("terms").flatten().dictionary_encode()
                code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                key = row * max(len(coded.dictionary), 1) + code
                order = np.argsort(key, kind="stable")
                first = np.flatnonzero(np.r_[True, key[order][1:] != key[order][:-1]]) if len(key) else order
                tf = np.diff(np.r_[first, len(key)])
                own, term = row[order][first], coded.dictionary.take(pa.array(code[order][first]))
                wanted = batch.column("_wanted").to_numpy(zero_copy_only=False).astype(bool)[own]
                sizes = np.where(wanted, tf, 0)
                offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
                places = pa.ListArray.from_arrays(offsets, pa.array(place[order][np.repeat(wanted, tf)].astype(np.int32)), mask=pa.array(~wanted))
                counted = [*(batch.column(n).take(pa.array(own)) for n in names), term, pa.array(tf.astype(np.int32)), places]
                yield pa.RecordBatch.from_arrays(counted, names=[*names, "term", "tf", "positions"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "term string, tf int, positions array<int>"])
    return rows.withColumn("_wanted", with_positions).mapInArrow(work, schema)


def postings(
    documents: DataFrame,
    positional: list[str] | None = None,
    split_city: bool = False,
    pieces: DataFrame | None = None,
    holders: DataFrame | None = None,
) -> DataFrame:
    """One row per field, term and document: field, term, doc_id, dl, tf, positions.

    They are made within the row of a document, so texts are not shuffled. Positions are kept for the
    ``positional`` fields, the ones phrases look at.  The text of a matched page may come in ``pieces``
    (doc_id, rank, wiki_text) instead of a column; with ``holders`` (doc_id, group), pieces are those of groups of documents.
    """
    positional = ["title"] if positional is None else positional
    terms = field_terms(documents, split_city)
    columns = ["field", "term", "doc_id", "dl", "tf", "positions"]
    counted = counted_rows(terms, F.col("field").isin(positional)).select(*columns)
    if pieces is None:
        return counted
    if holders is None:
        return counted.unionByName(_postings_of_pieces(pieces, "wiki_text" in positional).select(*columns))
    # Texts of a group are counted once; its documents get the counts.
    of_groups = _postings_of_pieces(pieces.withColumnRenamed("group", "doc_id"), "wiki_text" in positional)
    return counted.unionByName(of_groups.withColumnRenamed("doc_id", "group").join(holders, "group").select(*columns))


def _postings_of_pieces(pieces: DataFrame, positional: bool) -> DataFrame:
    """Postings of a field that comes in pieces: counts add up, and places go on from piece to piece."""
    terms = pieces.select("doc_id", "rank", analysed_terms(F.col("wiki_text")).alias("terms")).where(F.size("terms") > 0)
    before = F.lit(0)
    if positional:
        earlier = Window.partitionBy("doc_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
        terms = terms.withColumn("before", F.coalesce(F.sum(F.size("terms")).over(earlier), F.lit(0)).cast("int"))
        before = F.col("before")
    counted = counted_rows(terms.select("doc_id", before.alias("before"), "terms"), F.lit(positional))
    places = F.sort_array(F.flatten(F.collect_list(F.transform("positions", lambda p: p + F.col("before"))))) if positional else F.lit(None).cast("array<int>")
    added = counted.groupBy("doc_id", "term").agg(F.sum("tf").cast("int").alias("tf"), places.alias("positions"))
    lengths = terms.groupBy("doc_id").agg(F.sum(F.size("terms")).cast("int").alias("dl"))
    return added.join(lengths, "doc_id").withColumn("field", F.lit("wiki_text"))


def doc_lengths(terms: DataFrame) -> DataFrame:
    return terms.select("field", "doc_id", "dl").distinct()


def term_stats(posted: DataFrame) -> DataFrame:
    return posted.groupBy("field", "term").agg(F.count("*").alias("df"))


def field_stats(
    posted: DataFrame, documents: DataFrame, split_city: bool = False, pieces: DataFrame | None = None, holders: DataFrame | None = None
) -> DataFrame:
    """Documents that have the field and its mean length in them.

    Term frequencies add up to the lengths, and whether a document has a field shows in its
    text, so neither number needs a grouping by document (but for a field in pieces).
    """
    has = {f: F.col(f).rlike(ANALYSED_WORD) for f in TEXT_FIELDS if f in documents.columns}
    has["city"] = F.col("city").rlike(ANALYSED_WORD) if split_city else F.col("city") != ""
    counts = documents.agg(*[F.count_if(c).alias(f) for f, c in has.items()])
    n_docs = counts.select(
        F.inline(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("n_docs")) for f in has]))
    )
    if pieces is not None:
        with_text = pieces.where(F.col("wiki_text").rlike(ANALYSED_WORD))
        if holders is not None:
            with_text = holders.join(with_text.select("group").distinct(), "group")
        n_docs = n_docs.unionByName(with_text.agg(F.count_distinct("doc_id").alias("n_docs")).select(F.lit("wiki_text").alias("field"), "n_docs"))
    lengths = posted.groupBy("field").agg(F.sum("tf").alias("n_terms"))
    return lengths.join(n_docs, "field").select("field", "n_docs", (F.col("n_terms") / F.col("n_docs")).alias("avgdl"))


def write_index(
    documents: DataFrame,
    path: str,
    positional: list[str] | None = None,
    split_city: bool = False,
    buckets: int | None = None,
    pieces: DataFrame | None = None,
    numbers: DataFrame | None = None,
    holders: DataFrame | None = None,
) -> str:
    """Build an index of ``documents`` at ``path``; from its end on, it is the one that readers get. Returns its folder.

    ``pieces``: texts of matched pages, if documents have no column of them, and their ``holders``, if they are those of groups. ``numbers``: what the documents'
    numbers stand for, kept beside the index for the next build.

    Postings lie in folders by field and bucket (a hash of the term) and are sorted by term in each
    file: a search reads only the buckets of its terms.  Adaptive execution splits buckets that are large, as
    those of common terms are, by documents, and joins small ones.
    """
    spark = documents.sparkSession
    folder = f"build-{time.time_ns()}-{uuid.uuid4().hex[:8]}"
    base = f"{path}/{folder}"
    # What documents are made of may be a long plan of joins; it runs once.
    documents.write.parquet(f"{base}/documents")
    documents = spark.read.parquet(f"{base}/documents")
    if pieces is not None:
        pieces.write.parquet(f"{base}/pieces")
        pieces = spark.read.parquet(f"{base}/pieces")
    if holders is not None:
        holders.write.parquet(f"{base}/holders")
        holders = spark.read.parquet(f"{base}/holders")
    if numbers is not None:
        numbers.write.parquet(f"{base}/numbers")
    if buckets is None:
        buckets = min(max(documents.count() // DOCS_PER_BUCKET, LEAST_BUCKETS), MOST_BUCKETS)

    def laid_out(table: DataFrame, name: str, *order: str) -> None:
        with_bucket = table.withColumn("bucket", bucket_of(F.col("term"), buckets))
        dealt = with_bucket.hint("rebalance", "field", "bucket").sortWithinPartitions("field", "bucket", *order)
        dealt.write.partitionBy("field", "bucket").parquet(f"{base}/{name}")

    laid_out(postings(documents, positional, split_city, pieces, holders), "postings", "term", "doc_id")
    posted = spark.read.parquet(f"{base}/postings")
    laid_out(term_stats(posted), "term_stats", "term")
    field_stats(posted, documents, split_city, pieces, holders).write.parquet(f"{base}/field_stats")
    done = spark.createDataFrame([(time.time_ns(), folder, buckets)], "number long, folder string, buckets int")
    done.coalesce(1).write.mode("append").parquet(f"{path}/versions")
    return folder


def versions(spark: SparkSession, path: str) -> DataFrame:
    """Complete builds at ``path`` (number, folder, buckets); the largest number is the latest."""
    return spark.read.schema("number long, folder string, buckets int").parquet(f"{path}/versions")


def latest(spark: SparkSession, path: str, folder: str | None = None) -> Row | None:
    """The row of ``versions`` with the largest number, or that of ``folder``."""
    try:
        found = versions(spark, path)
        return (found if folder is None else found.where(F.col("folder") == folder)).orderBy(F.desc("number")).first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_numbers(spark: SparkSession, path: str) -> DataFrame | None:
    """Numbers of documents of the latest build, None before the first."""
    chosen = latest(spark, path)
    return chosen and spark.read.parquet(f"{path}/{chosen.folder}/numbers")


def read_index(spark: SparkSession, path: str, folder: str | None = None) -> Index:
    """The latest build at ``path``, or that of ``folder``."""
    chosen = latest(spark, path, folder)
    if chosen is None:
        raise ValueError(f"no complete index at {path}")
    documents, *others = [
        spark.read.parquet(f"{path}/{chosen.folder}/{t}") for t in ("documents", "postings", "term_stats", "field_stats")
    ]
    return Index(documents.select(*SHOWN), *others, buckets=chosen.buckets)


def in_memory_index(
    documents: DataFrame,
    positional: list[str] | None = None,
    split_city: bool = False,
    pieces: DataFrame | None = None,
    holders: DataFrame | None = None,
) -> Index:
    """The same tables as plans, for small inputs and tests."""
    posted = postings(documents, positional, split_city, pieces, holders)
    return Index(documents.select(*SHOWN), posted, term_stats(posted), field_stats(posted, documents, split_city, pieces, holders))
