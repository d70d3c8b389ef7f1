"""Landed RSS feeds as raw articles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.functions.timestamps import mail_date_to_iso, mail_date_to_utc_iso
from pressloom.schemas import RSS_ITEM


def read_rss_items(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", "item").schema(RSS_ITEM).load(path)


def _articles(items: DataFrame, source: str, summary: Column, iso: Column, scraped_at: Column) -> DataFrame:
    kept = [c for c in items.columns if c not in RSS_ITEM.names and c != "scraped_at"]
    return items.select(
        *kept,
        F.coalesce("title", F.lit("")).alias("title"),
        summary.alias("summary"),
        F.coalesce("link", F.lit("")).alias("url"),
        F.col("pubDate").alias("published"),
        iso.alias("published_iso"),
        F.lit(source).alias("source"),
        scraped_at.cast("string").alias("scraped_at"),
    )


def n12_articles(items: DataFrame, scraped_at: Column) -> DataFrame:
    """The short description wins over the description; the ISO date keeps its offset, '' when there is none."""
    summary = F.coalesce("shortDescription", "description", F.lit(""))
    return _articles(items, "n12", summary, mail_date_to_iso(F.col("pubDate")), scraped_at)


def kan11_articles(items: DataFrame, scraped_at: Column) -> DataFrame:
    """Description only; the ISO date is zone-less UTC, NULL when there is none."""
    summary = F.coalesce("description", F.lit(""))
    return _articles(items, "kan11", summary, mail_date_to_utc_iso(F.col("pubDate")), scraped_at)
