"""Row-wise steps and filters on article records."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.functions import text, timelabels, urls
from pressloom.functions.text import SECTION_TITLES, blank_if_null, strip
from pressloom.functions.timestamps import legacy_key, parse_instant

MIN_REPEATS = 5
MIN_SHARE = 0.5


def adapt(records: DataFrame, dual_forms: bool = False) -> DataFrame:
    """Resolve `published` labels against `scraped_at`; a value that is not a label blanks both time fields."""
    label = strip(blank_if_null(F.col("published")))
    read = timelabels.with_parsed_label(records, label, F.col("scraped_at"), "published_iso", dual_forms)
    is_label = timelabels.is_time_label(F.col("published"))
    return (
        read.withColumn("published", label)
        .withColumn("_label", is_label)
        .withColumns({c: F.when(F.col("_label"), F.col(c)).otherwise("") for c in ("published", "published_iso")})
        .drop("_label")
    )


def with_record_key(records: DataFrame) -> DataFrame:
    """Canonical URL, site id and record key.  The source is trimmed and lowered for the id and the key only."""
    source = F.lower(strip(blank_if_null(F.col("source"))))
    # Each step reads the one before as a column: the id and the key are both cut from the canonical URL.
    keyed = records.withColumn("url", urls.canonicalize_url(F.col("url")))
    keyed = keyed.withColumn("url_id", urls.extract_url_id(F.col("url"), source))
    return keyed.withColumn("record_key", urls.build_record_key(source, F.col("url"), F.col("url_id")))


def with_normal_texts(records: DataFrame) -> DataFrame:
    """Normalised title and summary, and the aggressive forms, which are made from the raw texts."""
    return records.withColumns(
        {f"{c}_norm_min": text.norm_min(F.col(c)) for c in ("title", "summary")}
        | {c: text.normalize_text(F.col(c)) for c in ("title", "summary")}
    )


def preprocess(records: DataFrame) -> DataFrame:
    return with_record_key(with_normal_texts(records))


def preprocess_legacy(records: DataFrame) -> DataFrame:
    """The older record form: section pages dropped, clean title, parsed time and the title-and-day key."""
    kept = drop_section_titles(records)
    parsed = kept.withColumns(
        {
            "summary": text.normalize_summary(F.col("summary")),
            "clean_title": text.clean_title(F.col("title")),
            "published_dt": parse_instant(F.col("published_iso")),
        }
    )
    when = F.col("published_dt")
    return parsed.withColumns(
        {
            "published_iso": F.when(when.isNotNull(), F.col("published_iso")).otherwise(""),
            "dedup_key": legacy_key(F.col("clean_title"), when),
        }
    )


def with_columns(df: DataFrame, defaults: Mapping[str, str | None]) -> DataFrame:
    """Add the columns that are missing, filled with their default."""
    missing = {c: F.lit(v).cast("string") for c, v in defaults.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def with_cluster_text(df: DataFrame, fields: Sequence[str] = ("title",)) -> DataFrame:
    """`text_for_cluster` from the normal forms of `fields`; rows without any text are dropped."""
    for f in fields:
        if f"{f}_norm_min" not in df.columns:
            df = df.withColumn(f"{f}_norm_min", text.norm_min(F.col(f)))
    parts = [blank_if_null(F.col(f"{f}_norm_min")) for f in fields]
    joined = strip(F.concat_ws(" ", *parts) if len(parts) > 1 else parts[0])
    return df.withColumn("text_for_cluster", joined).where(F.col("text_for_cluster") != "")


def with_instant(df: DataFrame, column: str = "published") -> DataFrame:
    return df.withColumn("_dt", parse_instant(F.col(column)))


def _moment(as_of: str | Column) -> Column:
    return F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of


def in_date_range(df: DataFrame, date_from: str | None = None, date_to: str | None = None) -> DataFrame:
    """Rows whose UTC day lies in the range, both ends included."""
    day = F.to_date("_dt")
    if date_from:
        df = df.where(day >= F.lit(date_from).cast("date"))
    if date_to:
        df = df.where(day <= F.lit(date_to).cast("date"))
    return df


def in_last_days(df: DataFrame, as_of: str | Column, days: int = 2) -> DataFrame:
    """Rows of the last `days` whole days, counted back from the day of `as_of`."""
    return df.where(F.to_date("_dt") > F.date_sub(F.to_date(_moment(as_of)), days))


def in_last_hours(df: DataFrame, as_of: str | Column, hours: int) -> DataFrame:
    """Rows younger than `hours` at the moment `as_of`."""
    return df.where(F.col("_dt") > _moment(as_of) - F.make_dt_interval(hours=F.lit(hours)))


def suspicious_titles(df: DataFrame, max_length: int = 6, sections: Iterable[str] = SECTION_TITLES) -> DataFrame:
    return df.where((F.char_length("title") <= max_length) | F.col("title").isin(*sections))


def drop_section_titles(df: DataFrame, sections: Iterable[str] = SECTION_TITLES) -> DataFrame:
    return df.where(~blank_if_null(F.col("title")).isin(*sections))


def drop_boilerplate(df: DataFrame, min_repeats: int = MIN_REPEATS, min_share: float = MIN_SHARE) -> DataFrame:
    """Drop the rows of a source whose summary repeats at least `min_repeats` times and makes up `min_share` of it.

    Blank summaries are kept.  Summaries are counted by a 96-bit print of their text and its length, through partial sums; only the few guilty
    prints are joined back, so no text is a key.
    """
    print_of = F.struct(F.xxhash64("summary").alias("h"), F.crc32("summary").alias("c"), F.length("summary").alias("n"))
    per_summary = df.groupBy("source", print_of.alias("_print")).agg(
        F.count("*").alias("_n"), F.max(blank_if_null(F.col("summary")) != "").alias("_text")
    )
    per_source = per_summary.groupBy(F.col("source").alias("_source")).agg(F.sum("_n").alias("_total"))
    guilty = per_summary.where((F.col("_n") >= min_repeats) & F.col("_text"))
    guilty = guilty.join(per_source, F.col("source").eqNullSafe(F.col("_source")))
    guilty = guilty.where(F.col("_n") >= F.lit(min_share) * F.col("_total"))
    guilty = guilty.select(F.col("source").alias("_source"), "_print")
    same = F.col("source").eqNullSafe(F.col("_source")) & (print_of == F.col("_print"))
    return df.join(guilty, same, "left_anti")


def pull_field(df: DataFrame, field: str = "published") -> DataFrame:
    return df.select(field)
