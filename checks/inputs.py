"""Activities and pages derived from the given tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeweave.sources.tables import read_table, spread


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_table(spark, sf, name)


def texts(spark: SparkSession, sf: str, name: str = "documents") -> DataFrame:
    return spread(read_table(spark, sf, name))


# Every part is an activity of the city named like its brand ...
ACTIVITIES_SQL = """
activities AS (
  SELECT concat('part/', p_partkey) AS url, p_name AS name, p_brand AS city,
         concat(p_type, ' ', p_size) AS description, [p_type, p_brand] AS highlights
  FROM part)"""


def activities(spark: SparkSession, sf: str) -> DataFrame:
    return texts(spark, sf, "part").select(
        F.concat(F.lit("part/"), F.col("p_partkey").cast("string")).alias("url"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("city"),
        F.concat_ws(" ", "p_type", F.col("p_size").cast("string")).alias("description"),
        F.array("p_type", "p_brand").alias("highlights"),
    )


# ... and a page lying in that city; every brand has a city page besides.
WIKI_SQL = """
wiki AS (
  SELECT p_name AS title, concat('wiki/part/', p_partkey) AS url, lower(p_type) AS type,
         [p_brand, p_type] AS geo_parent, concat(p_type, ' ', p_size, ' ', p_name) AS abstract,
         p_type AS architect, CASE WHEN p_size > 25 THEN concat('size ', p_size) ELSE '' END AS style
  FROM part
  UNION ALL
  SELECT DISTINCT p_brand, concat('wiki/brand/', p_brand), 'city', [p_brand], concat('All about ', p_brand), NULL, NULL
  FROM part)"""


def wiki_pages(spark: SparkSession, sf: str) -> DataFrame:
    part = texts(spark, sf, "part")
    size = F.col("p_size").cast("string")
    things = part.select(
        F.col("p_name").alias("title"),
        F.concat(F.lit("wiki/part/"), F.col("p_partkey").cast("string")).alias("url"),
        F.lower("p_type").alias("type"),
        F.array("p_brand", "p_type").alias("geo_parent"),
        F.concat_ws(" ", "p_type", size, "p_name").alias("abstract"),
        F.struct(
            F.col("p_type").alias("architect"),
            F.when(F.col("p_size") > 25, F.concat(F.lit("size "), size)).otherwise("").alias("style"),
        ).alias("fields"),
    )
    cities = part.select("p_brand").distinct().select(
        F.col("p_brand").alias("title"),
        F.concat(F.lit("wiki/brand/"), "p_brand").alias("url"),
        F.lit("city").alias("type"),
        F.array("p_brand").alias("geo_parent"),
        F.concat(F.lit("All about "), "p_brand").alias("abstract"),
        F.lit(None).cast(things.schema["fields"].dataType).alias("fields"),
    )
    return things.unionByName(cities)
