"""Landed JSON files as article rows.

The arrival order inside a file decides which duplicate is "first", so every row has its position in its file.  Arrays are
read by byte ranges (`json_ranges`), objects that hold an array whole.  A file that is not valid JSON, or not of the expected
shape, gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.schemas import ARTICLE_FIELDS
from pressloom.sources.json_ranges import read_arrays

_RECORD = "map<string,string>"
_DAY = r"(?:\A|_)(\d{4}-\d{2}-\d{2})\z"


def file_stem(name: Column) -> Column:
    return F.regexp_replace(name, r"\.[^.]*\z", "")


def file_day(name: Column) -> Column:
    """Day in the last '_' part of a file name, NULL when there is none."""
    return F.regexp_extract(file_stem(name), _DAY, 1).try_cast("date")


def _records(df: DataFrame, payload: Column, fields: Sequence[str]) -> DataFrame:
    """One row per record of an array of maps: the known fields, the unknown ones in `extra`, and the position."""
    carried = [c for c in df.columns if c != "value"]
    rows = df.select(*carried, F.posexplode(payload).alias("_at", "_rec"))
    extra = F.map_filter("_rec", lambda k, v: ~k.isin(*fields))
    return rows.select(
        *[F.col("_rec").getItem(f).alias(f) for f in fields],
        F.when(F.size(extra) > 0, extra).alias("extra"),
        *carried,
        F.col("_at").cast("long").alias("_pos"),
    )


def _parsed(shape: str, opens_with: str) -> Column:
    """The text as `shape`, NULL where it is not JSON or opens otherwise.  There is no limit on its length."""
    return F.when(F.col("value").rlike(rf"\A\s*\{opens_with}"), F.from_json("value", shape))


def explode_arrays(files: DataFrame, fields: Sequence[str] = ARTICLE_FIELDS) -> DataFrame:
    """Rows of files (column `value` holds the text) that hold a JSON array of records."""
    return _records(files, _parsed(f"array<{_RECORD}>", "["), fields)


def explode_arrays_or_wrapped(files: DataFrame, fields: Sequence[str] = ARTICLE_FIELDS) -> DataFrame:
    """As `explode_arrays`, and also files that hold an object with the array under `records`."""
    wrapped = _parsed(f"struct<records:array<{_RECORD}>>", "{").getField("records")
    return _records(files, F.coalesce(_parsed(f"array<{_RECORD}>", "["), wrapped), fields)


def _read_whole(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    reader = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    return reader.text(folder, wholetext=True).select("value", F.col("_metadata.file_name").alias("_file"))


def read_feed_files(spark: SparkSession, folder: str, pattern: str, rank: int = 0) -> DataFrame:
    """Articles of one feed: `<feed>_<day>.json` files; files whose name has no day are left out.

    `rank` orders feeds among each other; inside a feed the file name orders the files.
    """
    rows = read_arrays(spark, folder, pattern).withColumn("dt", file_day(F.col("_file")))
    return rows.where("dt IS NOT NULL").withColumn("_file_rank", F.lit(rank))


def read_daily_inputs(spark: SparkSession, adapted_folder: str, raw_folder: str) -> DataFrame:
    """All feeds of all days, adapted files before raw ones."""
    adapted = read_feed_files(spark, adapted_folder, "c14_adapted_*.json", rank=0)
    raw = read_feed_files(spark, raw_folder, "n12_rss_*.json", rank=1)
    return adapted.unionByName(raw, allowMissingColumns=True)


def read_scraped(spark: SparkSession, raw_folder: str) -> DataFrame:
    """Input of the adapter step."""
    return read_feed_files(spark, raw_folder, "c14_scraped_*.json")


PROCESSED_FIELDS = (*ARTICLE_FIELDS, "title_norm_min", "summary_norm_min", "url_id", "record_key")


def read_articles(spark: SparkSession, folder: str, fields: Sequence[str] = PROCESSED_FIELDS) -> DataFrame:
    """All articles of a folder: `.json` arrays or wrapped arrays, and `.jsonl` with one object per line."""
    whole = explode_arrays_or_wrapped(_read_whole(spark, folder, "*.json"), fields)
    return whole.unionByName(read_json_lines(spark, folder, fields))


def read_json_lines(spark: SparkSession, folder: str, fields: Sequence[str], pattern: str = "*.jsonl") -> DataFrame:
    """One object per line; blank lines and lines that are not JSON are left out.  Large files stay splittable."""
    lines = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").text(folder)
    # Order inside a file: start of the split in MiB, then the row number inside the task.
    split = F.shiftleft(F.shiftright(F.col("_metadata.file_block_start"), 20), 33)
    at = split + F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rec = F.when(F.col("value").rlike(r"\A\s*\{"), F.from_json("value", _RECORD))
    one = lines.select("value", F.col("_metadata.file_name").alias("_file"), at.alias("_line"))
    one = one.where(F.trim("value") != "").select("_file", "_line", F.array(rec).alias("_one"))
    rows = _records(one.where(F.col("_one")[0].isNotNull()), F.col("_one"), fields)
    return rows.withColumn("_pos", F.col("_line")).drop("_line", "_one")


def read_grouped(spark: SparkSession, path: str, fields: Sequence[str]) -> DataFrame:
    """Clustered articles kept as JSON arrays; absent fields come back as NULL."""
    return read_arrays(spark, path, "*.json", fields).drop("extra")
