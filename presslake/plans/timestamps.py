"""Queries of problem 3: one instant in UTC for each time as landed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslake.operators.portal_names import with_portal
from presslake.operators.timestamps import normalize_timestamps, utc_text
from presslake.session import bounded_rows, table


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value of the three columns that fixes a date with a time, as UTC text."""
    portals = table(spark, sf_dir, "portals")
    zones = [r.tz_name for r in bounded_rows(portals.select("tz_name").distinct(), 1000, "zones")]
    articles = with_portal(table(spark, sf_dir, "articles").select("id", "source_name", "published_at", "fetched_at"), portals, "source_name", ["tz_name", "date_order"])
    entry = lambda field, value, zone, mdy: F.struct(F.lit(field).alias("field_name"), value.alias("raw"), zone.alias("zone"), mdy.alias("mdy"))
    mdy = F.coalesce(F.col("date_order") == "mdy", F.lit(False))
    values = articles.select(
        F.col("id").cast("string").alias("rec_id"),
        F.inline(F.array(entry("articles.published_at", F.col("published_at"), F.col("tz_name"), mdy), entry("articles.fetched_at", F.col("fetched_at"), F.lit("Asia/Baku"), F.lit(False)))),
    ).unionByName(
        table(spark, sf_dir, "news").select(F.col("id").alias("rec_id"), F.lit("news.published_at").alias("field_name"), F.col("published_at").alias("raw"), F.lit("UTC").alias("zone"), F.lit(False).alias("mdy"))
    )
    done = normalize_timestamps(values, "raw", F.col("zone"), F.col("mdy"), [*zones, "Asia/Baku", "UTC"])
    return done.where(F.col("utc_us").isNotNull()).select("field_name", "rec_id", utc_text(F.col("utc_us")).alias("utc_text"))


QUERIES = {"p3_found": p3_found}
SQL: dict[str, str] = {}
