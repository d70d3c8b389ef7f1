"""Small helpers shared by the pipeline operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Runs of ASCII letters, digits and non-ASCII characters, of a text without capital A-Z.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Runs of anything but ASCII white space.
TOKEN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: str | Column) -> Column:
    """A text column with NULL as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def words(text: str | Column) -> Column:
    return F.regexp_extract_all(ascii_lower(whole(text)), F.lit(WORD), F.lit(0))


def tokens(text: str | Column) -> Column:
    return F.regexp_extract_all(whole(text), F.lit(TOKEN), F.lit(0))


def gram_hash(array: str | Column, at: Column, size: int) -> Column:
    """XXH64 over `size` neighbouring elements; elements beyond the end do not count."""
    col = F.col(array) if isinstance(array, str) else array
    return F.xxhash64(*[F.get(col, at + j) for j in range(size)])


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Texts can be long, so a Python worker gets at most `rows` of them at once."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))
