"""Readers of sitemaps, feeds and JSON state, all with fixed schemas so that nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SITEMAP = "loc string, lastmod string, news struct<publication:struct<name:string,language:string>,publication_date:string,title:string>, image struct<loc:string>"
_ITEM = "link string, title string, category string, description string, pubDate string, encoded string, enclosure struct<_url:string>"


def read_sitemap(spark: SparkSession, path: str, row: str = "url") -> DataFrame:
    """Entries of sitemaps or news sitemaps; ``row='sitemap'`` reads an index."""
    return spark.read.format("xml").option("rowTag", row).option("ignoreNamespace", "true").schema(_SITEMAP).load(path)


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """Items of RSS feeds."""
    raw = spark.read.format("xml").option("rowTag", "item").option("ignoreNamespace", "true").schema(_ITEM).load(path)
    return raw.select("link", "title", "category", "description", F.col("pubDate").alias("pub_date"), F.col("enclosure._url").alias("image_url"), F.col("encoded").alias("content_html"))


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """(key, value) of a JSON state file; absent keys and broken files give no rows."""
    text = spark.read.option("wholetext", "true").text(path)
    return text.select(F.explode(F.coalesce(F.from_json("value", "map<string,string>"), F.create_map().cast("map<string,string>"))).alias("key", "value"))


def id_window(spark: SparkSession, high: int, width: int, forward: bool = True) -> DataFrame:
    """Ids to probe next to a known one: forward without it, or backward without it."""
    return spark.range(high + 1, high + width + 1).toDF("id") if forward else spark.range(high - 1, max(high - width - 1, 0), -1).toDF("id")
