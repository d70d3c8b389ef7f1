"""Duplicates: keep the first or the latest row of a key, or report the repeats.

Keeping one row per key is a row number with a limit of one.  Spark applies that limit before the shuffle too, so each
map task sends at most one row per key and a key that holds a large share of all rows stays cheap.  A row whose key is
blank is given a key of its own instead of a side condition, which would switch that limit off.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ARRIVAL = ("_file_rank", "_file", "_pos")


def arrival_order(df: DataFrame, descending: bool = False) -> list[Column]:
    """Order in which rows came in, from the columns that say so."""
    cols = [c for c in ARRIVAL if c in df.columns]
    return [F.desc(c) if descending else F.asc(c) for c in cols]


def first_per_key(df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column]) -> DataFrame:
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rn") == 1).drop("_rn")


def _own_key_if_blank(df: DataFrame, key: str) -> Column:
    """NULL for rows with a key; something unique to the row for rows without."""
    blank = F.col(key).isNull() | (F.col(key) == "")
    return F.when(blank, F.struct(*[c for c in ARRIVAL if c in df.columns]))


def keep_first_by_record_key(
    df: DataFrame, day: str | None = "dt", keep_blank_urls: bool = False, url: str = "url"
) -> DataFrame:
    """First row of each record key per day.  Rows without a key stay.

    Rows without a URL share one key per source; `keep_blank_urls` keeps them all instead.
    """
    order = arrival_order(df)
    keys = [F.col("record_key"), _own_key_if_blank(df, "record_key")]
    if day:
        keys.insert(0, F.col(day))
    if keep_blank_urls:
        no_url = F.coalesce(F.col(url), F.lit("")).isin("", "https://")
        keys.append(F.when(no_url, F.struct(*[c for c in ARRIVAL if c in df.columns])))
    return first_per_key(df, keys, order)


def keep_latest_by_title(df: DataFrame, time: str = "_dt") -> DataFrame:
    """Latest row of each normalised title within a source; undated rows count as oldest, later arrivals win ties."""
    order = [F.desc_nulls_last(time), *arrival_order(df, descending=True)]
    return first_per_key(df, ["source", "title_norm_min"], order)


def keep_first_by_dedup_key(df: DataFrame) -> DataFrame:
    """First row of each legacy key; all rows without a key count as one group."""
    return first_per_key(df, ["dedup_key"], arrival_order(df))


def keep_first_by_url(df: DataFrame, url: str = "url") -> DataFrame:
    """First row of each URL; rows without one all stay."""
    return first_per_key(df, [F.col(url), _own_key_if_blank(df, url)], arrival_order(df))


def repeated_urls(df: DataFrame, url: str = "url") -> DataFrame:
    """All rows of every URL that occurs more than once.

    The counts are partial sums; the join back is on a unique key, which adaptive execution splits when a URL is hot.
    """
    repeated = df.groupBy(F.col(url).alias("_url")).agg(F.count("*").alias("_n")).where(F.col("_n") > 1)
    return df.join(repeated.select("_url"), F.col(url).eqNullSafe(F.col("_url")), "left_semi")
