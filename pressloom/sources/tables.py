"""CSV, stop-word and per-day table inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.functions.text import strip
from pressloom.schemas import PROCESSED_ARTICLE


def read_clustered_csv(spark: SparkSession, path: str) -> DataFrame:
    """Clustered articles as CSV with quoted line breaks; a byte order mark before the header is removed."""
    options = {"header": True, "multiLine": True, "quote": '"', "escape": '"', "encoding": "UTF-8"}
    df = spark.read.options(**options).csv(path)
    return df.withColumnsRenamed({c: c.lstrip("\ufeff").strip('"') for c in df.columns if c.startswith("\ufeff")})


def read_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """One word per line; blank lines and lines that start with '#' are skipped, repeats removed."""
    words = spark.read.text(path).select(strip(F.col("value")).alias("word"))
    return words.where((F.col("word") != "") & ~F.col("word").startswith("#")).distinct()


def read_processed_day(spark: SparkSession, path: str, as_of: str) -> DataFrame:
    """Processed articles of one day; only that day's partition is read."""
    rows = spark.read.schema(PROCESSED_ARTICLE).json(path)
    return rows.where(F.col("dt") == F.lit(as_of).cast("date"))
