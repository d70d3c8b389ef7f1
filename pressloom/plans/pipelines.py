"""The three runs of the engine as DataFrame plans: daily ETL, event clustering, cluster post-processing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressloom.operators import dedup, records, reports
from pressloom.operators.features import CharGrams
from pressloom.operators.linkage import average_linkage


def daily(records_in: DataFrame, keep_blank_urls: bool = False) -> DataFrame:
    """Landed records to processed ones, without repeats inside a day: one pass and one shuffle.

    Repeats go before the texts are normalised, so only raw texts are shuffled and only kept rows are worked on.
    """
    kept = dedup.keep_first_by_record_key(records.with_record_key(records_in), keep_blank_urls=keep_blank_urls)
    return records.with_normal_texts(kept)


def clustering_frame(
    processed: DataFrame, time: str = "published", fields: Sequence[str] = ("title",), max_articles: int | None = None
) -> DataFrame:
    """Articles ready for clustering: text, time, latest row per outlet and title.

    `max_articles` keeps the undated and oldest ones only; there is no cap unless asked for.
    """
    frame = records.with_instant(records.with_cluster_text(processed, fields), time)
    frame = dedup.keep_latest_by_title(frame)
    if max_articles is not None:
        frame = oldest(frame, max_articles)
    return frame


def in_time_order(frame: DataFrame) -> DataFrame:
    return frame.orderBy(F.asc_nulls_first("_dt"), *dedup.arrival_order(frame))


def ranked_in_time(frame: DataFrame) -> DataFrame:
    """The frame with each row's `place` in time, undated rows first."""
    return reports.running_places(frame, [F.asc_nulls_first("_dt"), *dedup.arrival_order(frame)])


def oldest(frame: DataFrame, n: int) -> DataFrame:
    return in_time_order(frame).limit(n)


def events(
    frame: DataFrame,
    doc: str = "doc_id",
    threshold: float = 0.83,
    ngram_range: tuple[int, int] = (1, 2),
    min_df: int = 2,
    max_df: float = 0.75,
    stopwords: Sequence[str] | DataFrame = (),
    chars: CharGrams | None = None,
) -> DataFrame:
    """Articles with the `cluster` they belong to; `chars` compares headlines by character n-grams as well."""
    return average_linkage(
        frame, doc, "text_for_cluster", threshold, ngram_range, min_df, max_df, stopwords, chars=chars
    )


def event_outputs(clustered: DataFrame) -> dict[str, DataFrame]:
    """The tables that `sinks.write_cluster_run` writes."""
    return {
        "articles": reports.review_order(clustered),
        "clusters_summary": reports.by_size(reports.run_summary(clustered)),
        "clusters": reports.nested_clusters(clustered),
        "stats": reports.run_stats(clustered),
    }


GROUPED_DEFAULTS = {
    c: None
    for c in ("cluster_id", "title", "summary", "url", "source", "published_dt", "scraped_at", "clean_title")
}


def postprocess(grouped: DataFrame) -> dict[str, DataFrame]:
    """Representatives per cluster and the article list of grouped articles."""
    full = records.with_columns(grouped, GROUPED_DEFAULTS)
    return {
        "clusters_summary": reports.by_size(reports.post_summary(full), "size", "cluster_id"),
        "articles_by_cluster": reports.articles_by_cluster(full),
        "metrics": reports.run_stats(full, "cluster_id", denominator="clusters"),
    }
