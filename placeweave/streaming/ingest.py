"""Incremental extraction of dump chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from placeweave.operators import wiki
from placeweave.sources import wiki_xml


def stream_pages(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream of (title, text) over the chunks of a dump folder."""
    reader = spark.readStream.format("text").option("lineSep", wiki_xml.PAGE_END)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return wiki_xml.title_and_text(wiki_xml.parsed(reader.load(path)))


def extract_new_chunks(
    spark: SparkSession, chunks: str, out: str, checkpoint: str, cities: bool = False, files_per_batch: int | None = None
) -> StreamingQuery:
    """Extract the chunks not seen before and stop.

    The checkpoint remembers every chunk, including those without a single record, and a
    failed run is repeated without doubling or losing output.
    """
    pages = stream_pages(spark, chunks, files_per_batch)
    records = wiki.city_records(pages) if cities else wiki.page_records(pages)
    return (
        records.writeStream.format("json")
        .option("path", out)
        .option("ignoreNullFields", "false")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
