"""Article views over the given tables, so that every operator runs on data that Spark reads and derives.

A document is taken as an article: the headline is its first sentence and the summary its whole text.  The tables carry
no URLs of the known sites and no publication times, so both follow from the document number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EPOCH = "2025-08-10 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw articles with arrival order and landing day."""
    docs = table(spark, sf_dir, "documents")
    d = F.col("doc_id")
    slot = (d % 60).cast("string")
    url = (
        F.when(d % 5 == 4, None)
        .when(d % 3 == 0, F.concat(F.lit("HTTP://WWW.C14.co.il/article/"), slot, F.lit("/?utm="), d.cast("string")))
        .when(d % 3 == 1, F.concat(F.lit("https://www.mako.co.il/news/Article-"), slot, F.lit("x.htm?p=1#f")))
        .otherwise(F.concat(F.lit("http://Ex.com/p/"), slot, F.lit("//?q=1")))
    )
    moment = F.lit(EPOCH).cast("timestamp") + F.make_dt_interval(mins=(d * 7 % 20000).cast("int"))
    scraped = moment + F.make_dt_interval(hours=F.lit(1))
    mail = F.concat(F.date_format(moment, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0000"))
    iso = F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    return docs.select(
        "doc_id",
        F.regexp_extract("text", r"\A[^.\n]*", 0).alias("title"),
        F.col("text").alias("summary"),
        url.alias("url"),
        F.when(d % 11 == 0, None).when(d % 3 == 1, mail).otherwise(iso).alias("published"),
        F.lit("").alias("published_iso"),
        "source",
        F.date_format(scraped, "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("scraped_at"),
        F.to_date(scraped).alias("dt"),
        F.lit(0).alias("_file_rank"),
        d.alias("_pos"),
    )


def clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles with a cluster number that follows from the document number, for the report operators."""
    single = F.col("doc_id") % 10 == 3
    cluster = F.when(single, F.col("doc_id") + 1000).otherwise(F.col("doc_id") % 97)
    rows = articles(spark, sf_dir).withColumn("cluster", cluster)
    return rows.withColumns({"cluster_id": F.col("cluster"), "published_dt": F.col("published")})


def labelled_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a time label each; the time of the event is the scrape time, at offset +03:00."""
    e = F.col("event_id")
    n = (e % 70).cast("string")
    hour, minute = F.lpad((e % 26).cast("string"), 2, "0"), F.lpad((e % 63).cast("string"), 2, "0")
    forms = [
        F.concat(F.lit("לפני "), n, F.lit(" דקות")),
        F.concat(F.lit("לפני "), n, F.lit(" שעות")),
        F.lit("לפני כשעה"),
        F.lit("לפני שעתיים"),
        F.lit("לפני יום"),
        F.concat(F.lit("לפני "), n, F.lit(" ימים")),
        F.concat(F.lit("אתמול "), hour, F.lit(":"), minute),
        F.lit("אתמול"),
        F.concat(F.lit(" "), hour, F.lit(":"), minute, F.lit(" ")),
        F.concat(hour, F.lit("."), minute),
        F.concat(n, F.lit(" minutes ago")),
        F.concat(F.lit("Yesterday at "), hour, F.lit(":"), minute),
        F.concat(n, F.lit(" hrs ago")),
        F.lit("כותרת כתבה"),
        F.col("event_type"),
        F.lit(None).cast("string"),
    ]
    kind = e % len(forms)
    label = F.lit(None).cast("string")
    for i, form in reversed(list(enumerate(forms))):
        label = F.when(kind == i, form).otherwise(label)
    scraped = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+03:00'")
    return table(spark, sf_dir, "events").select("event_id", label.alias("label"), scraped.alias("scraped_at"))
