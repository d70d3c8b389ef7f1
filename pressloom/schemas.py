"""Column layouts of the stages.  Every stage keeps rows as they are and only adds columns."""

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


ARTICLE_FIELDS = ("title", "summary", "url", "published", "published_iso", "source", "scraped_at")

RAW_ARTICLE = _strings(*ARTICLE_FIELDS)

# Columns the file readers add so that "first", "last" and "in order" stay well defined.
ARRIVAL = T.StructType(
    [
        T.StructField("_file", T.StringType()),
        T.StructField("_file_rank", T.IntegerType()),
        T.StructField("_pos", T.LongType()),
    ]
)

PROCESSED_ARTICLE = T.StructType(
    RAW_ARTICLE.fields
    + _strings("title_norm_min", "summary_norm_min", "url_id", "record_key").fields
    + ARRIVAL.fields
    + [T.StructField("dt", T.DateType())]
)

RSS_ITEM = _strings("title", "link", "pubDate", "shortDescription", "description")
