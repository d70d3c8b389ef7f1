"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.functions import text, timelabels, timestamps, urls
from pressloom.operators import dedup, features, linkage, records, reports
from pressloom.plans import pipelines, views
from pressloom.schemas import RSS_ITEM
from pressloom.sources import feeds, html_pages, json_files

AS_OF = "2025-08-13 12:00:00"
QUERY_STOPWORDS = ("the", "and", "of", "to", "in", "la", "de")
WELCOME = "תודה שקראתם אותנו היום"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- URLs and keys ---------------------------------------------------------------------------------------------------


@query
def canonical_urls(spark, sf):
    return views.articles(spark, sf).select("doc_id", urls.canonicalize_url(F.col("url")).alias("canonical_url"))


@query
def url_ids(spark, sf):
    a = views.articles(spark, sf).withColumn("canonical_url", urls.canonicalize_url(F.col("url")))
    host = urls.host_of(F.col("canonical_url"))
    return a.select("doc_id", host.alias("host"), urls.extract_url_id(F.col("canonical_url"), F.col("source")).alias("url_id"))


@query
def record_keys(spark, sf):
    p = records.preprocess(views.articles(spark, sf))
    return p.select("doc_id", "record_key", urls.short_hash(F.col("url")).alias("url_hash"))


# --- texts -----------------------------------------------------------------------------------------------------------


@query
def normalized_text(spark, sf):
    a = views.articles(spark, sf)
    return a.select("doc_id", *[text.normalize_text(F.col(c)).alias(c) for c in ("title", "summary")])


def _decorated_title() -> Column:
    """Titles with the labels, suffixes, times and numbers that the normal form removes or masks."""
    title, kind = F.col("title"), F.col("doc_id") % 5
    return (
        F.when(kind == 0, F.concat(F.lit("צפו: "), title))
        .when(kind == 1, F.concat(title, F.lit(" | N12")))
        .when(kind == 2, F.concat(title, F.lit(" - ערוץ 14")))
        .when(kind == 3, F.concat(F.lit("ב-12:30 "), title, F.lit(" 1,250")))
        .otherwise(title)
    )


@query
def norm_min_titles(spark, sf):
    a = views.articles(spark, sf).withColumn("title", _decorated_title())
    return a.select(
        "doc_id",
        text.norm_min(F.col("title")).alias("title_norm_min"),
        text.norm_min(F.col("summary")).alias("summary_norm_min"),
    )


@query
def clean_titles(spark, sf):
    a = views.articles(spark, sf).withColumn("title", _decorated_title())
    return a.select(
        "doc_id",
        text.clean_title(F.col("title")).alias("clean_title"),
        text.normalize_summary(F.col("summary")).alias("clean_summary"),
    )


@query
def legacy_keys(spark, sf):
    a = views.articles(spark, sf).withColumn("published_iso", F.col("published"))
    p = records.preprocess_legacy(a)
    return p.select("doc_id", timestamps.utc_iso(F.col("published_dt")).alias("published_dt"), "dedup_key")


# --- time ------------------------------------------------------------------------------------------------------------


@query
def time_label_flags(spark, sf):
    e = views.labelled_events(spark, sf)
    return e.select(
        "event_id",
        timelabels.guess_locale(F.coalesce("label", F.lit(""))).alias("locale"),
        timelabels.is_time_label(F.col("label")).alias("is_label"),
    )


@query
def time_label_iso(spark, sf):
    e = views.labelled_events(spark, sf)
    for name, dual in (("iso", False), ("iso_dual", True)):
        e = timelabels.with_parsed_label(e, F.col("label"), F.col("scraped_at"), name, dual_forms=dual)
    return e.select("event_id", "iso", "iso_dual")


@query
def time_label_loose(spark, sf):
    e = views.labelled_events(spark, sf)
    parsed = timelabels.with_loosely_parsed_label(e, F.col("label"), F.col("scraped_at"), "iso")
    return parsed.select("event_id", "iso")


@query
def published_instants(spark, sf):
    a = records.with_instant(views.articles(spark, sf))
    return a.select(
        "doc_id",
        timestamps.utc_iso(F.col("_dt")).alias("utc"),
        timestamps.mail_date_to_iso(F.col("published")).alias("mail_iso"),
    )


@query
def date_range(spark, sf):
    a = records.with_instant(views.articles(spark, sf))
    return records.in_date_range(a, "2025-08-12", "2025-08-19").select("doc_id")


@query
def window_days(spark, sf):
    a = records.with_instant(views.articles(spark, sf))
    return records.in_last_days(a, AS_OF, 2).select("doc_id")


@query
def window_hours(spark, sf):
    a = records.with_instant(views.articles(spark, sf))
    return records.in_last_hours(a, AS_OF, 36).select("doc_id")


# --- records ---------------------------------------------------------------------------------------------------------


@query
def adapted_records(spark, sf):
    e = views.labelled_events(spark, sf).withColumnRenamed("label", "published")
    return records.adapt(e).select("event_id", "published", "published_iso")


@query
def processed_articles(spark, sf):
    p = records.preprocess(views.articles(spark, sf))
    return p.select(
        "doc_id", "title", "summary", "url", "source", "title_norm_min", "summary_norm_min", "url_id", "record_key"
    )


@query
def category_filter(spark, sf):
    a = views.articles(spark, sf)
    section = F.when(F.col("doc_id") % 9 == 0, "תרבות").when(F.col("doc_id") % 9 == 1, "ספורט").otherwise(F.col("title"))
    return records.drop_section_titles(a.withColumn("title", section)).select("doc_id", "title")


@query
def suspicious_titles(spark, sf):
    a = views.articles(spark, sf)
    section = F.when(F.col("doc_id") % 9 == 0, "תרבות").otherwise(F.col("title"))
    return records.suspicious_titles(a.withColumn("title", section)).select("doc_id", "source", "title")


@query
def boilerplate_filter(spark, sf):
    a = views.articles(spark, sf)
    greeted = F.col("source").isin("src1", "src2", "src3") & (F.floor(F.col("doc_id") / 20) % 5 < 3)
    a = a.withColumn("summary", F.when(greeted, WELCOME).when(F.col("source") == "src4", "").otherwise(F.col("summary")))
    return records.drop_boilerplate(a).select("doc_id", "source", "summary")


@query
def top_summaries(spark, sf):
    return reports.top_summaries(views.articles(spark, sf))


# --- duplicates ------------------------------------------------------------------------------------------------------


@query
def dedup_record_key(spark, sf):
    return pipelines.daily(views.articles(spark, sf)).select("doc_id", "dt", "record_key")


@query
def dedup_record_key_blank_kept(spark, sf):
    kept = pipelines.daily(views.articles(spark, sf), keep_blank_urls=True)
    return kept.select("doc_id", "dt", "record_key")


@query
def dedup_latest_title(spark, sf):
    return pipelines.clustering_frame(_processed(spark, sf)).select("doc_id", "source", "title_norm_min")


@query
def dedup_key_first(spark, sf):
    a = views.articles(spark, sf).withColumn("published_iso", F.col("published"))
    keyed = records.preprocess_legacy(a).withColumn("dedup_key", F.when(F.col("doc_id") % 11 != 0, F.col("dedup_key")))
    return dedup.keep_first_by_dedup_key(keyed).select("doc_id", "dedup_key")


@query
def duplicate_urls(spark, sf):
    p = _canonical(spark, sf)
    return dedup.repeated_urls(p).select("doc_id", "url")


@query
def dedup_url_keep_blank(spark, sf):
    p = views.articles(spark, sf).withColumn("url", F.regexp_replace("url", r"[?#].*\z", ""))
    return dedup.keep_first_by_url(p).select("doc_id", "url")


@query
def stage_counts(spark, sf):
    return reports.stage_counts(_canonical(spark, sf))


def _canonical(spark, sf):
    a = views.articles(spark, sf).withColumn("url", urls.canonicalize_url(F.col("url")))
    source = F.col("source")
    key = urls.build_record_key(source, F.col("url"), urls.extract_url_id(F.col("url"), source))
    return a.withColumn("record_key", key)


def _processed(spark, sf):
    """Articles with the normal form that clustering reads; the other processed columns are not needed there."""
    return views.articles(spark, sf).withColumn("title_norm_min", text.norm_min(F.col("title")))


def _frame(spark, sf):
    return pipelines.clustering_frame(_processed(spark, sf))


# --- similarity and clusters -----------------------------------------------------------------------------------------


@query
def tfidf_weights(spark, sf):
    w = features.tfidf(_frame(spark, sf), max_df=0.75)
    return w.select("doc_id", "term", F.round("w", 6).alias("w"))


@query
def tfidf_without_stopwords(spark, sf):
    w = features.tfidf(_frame(spark, sf), max_df=0.75, ngram_range=(1, 3), stopwords=QUERY_STOPWORDS)
    return w.select("doc_id", "term", F.round("w", 6).alias("w"))


@query
def cosine_pairs(spark, sf):
    pairs = linkage.cosine_pairs(_frame(spark, sf))
    return pairs.withColumn("sim", F.round("sim", 6))


@query
def event_clusters(spark, sf):
    return pipelines.events(_frame(spark, sf)).select("doc_id", "source", "cluster")


# --- reports ---------------------------------------------------------------------------------------------------------


@query
def cluster_sizes(spark, sf):
    return reports.with_cluster_size(views.clustered(spark, sf)).select("doc_id", "cluster", "cluster_size")


@query
def cluster_run_stats(spark, sf):
    c = views.clustered(spark, sf)
    per_article = reports.run_stats(c).withColumn("share_of", F.lit("articles"))
    per_cluster = reports.run_stats(c, denominator="clusters").withColumn("share_of", F.lit("clusters"))
    both = per_article.unionByName(per_cluster)
    return both.withColumn("pct_singletons", F.round("pct_singletons", 6))


@query
def cluster_summary(spark, sf):
    c = records.with_instant(views.clustered(spark, sf))
    return reports.by_size(reports.run_summary(c))


@query
def cluster_items(spark, sf):
    placed = reports.cluster_positions(views.clustered(spark, sf))
    return placed.select("cluster", "size", "pos", "source", "title", "url", "published")


@query
def cluster_items_nested(spark, sf):
    """Lists of four, so that most clusters take several rows."""
    nested = reports.nested_clusters(views.clustered(spark, sf), max_items=4)
    rows = nested.select("cluster", "size", "part", F.posexplode("items").alias("pos", "item"))
    return rows.select("cluster", "size", "part", "pos", "item.source", "item.title", "item.url", "item.published")


@query
def cluster_representatives(spark, sf):
    return reports.representatives(views.clustered(spark, sf)).select("cluster_id", "doc_id", "title", "url", "source")


@query
def cluster_timespan(spark, sf):
    return reports.by_size(reports.post_summary(views.clustered(spark, sf)), "size", "cluster_id")


@query
def source_spread(spark, sf):
    return reports.source_spread(views.clustered(spark, sf))


@query
def multi_source_share(spark, sf):
    share = reports.multi_source_share(reports.source_spread(views.clustered(spark, sf)))
    return share.select(*[F.round(c, 6).alias(c) for c in share.columns])


@query
def multi_source_articles(spark, sf):
    return reports.multi_source_articles(views.clustered(spark, sf)).select("doc_id", "cluster")


@query
def top_clusters(spark, sf):
    return reports.top_clusters(reports.cluster_sizes(views.clustered(spark, sf)))


@query
def top_multi_source_clusters(spark, sf):
    spread = reports.source_spread(views.clustered(spark, sf))
    return reports.top_clusters(spread, by=("n_sources", "cluster_size"))


@query
def cluster_samples(spark, sf):
    c = views.clustered(spark, sf)
    picked = reports.cluster_samples(c, dedup.arrival_order(c))
    return picked.select("cluster", "sample_rank", "doc_id", "title")


@query
def articles_by_cluster(spark, sf):
    return reports.articles_by_cluster(views.clustered(spark, sf))


@query
def cluster_top_terms(spark, sf):
    c = views.clustered(spark, sf)
    top = features.cluster_top_terms(c, word=r"\A[\p{L}]{2,}\z", max_df=0.95)
    return top.withColumn("weight", F.round("weight", 6))


@query
def time_ordered(spark, sf):
    a = records.with_instant(views.articles(spark, sf))
    return pipelines.in_time_order(a).select("doc_id", timestamps.utc_iso(F.col("_dt")).alias("utc"))


@query
def oldest_articles(spark, sf):
    a = records.with_instant(views.articles(spark, sf))
    return pipelines.oldest(a, 137).select("doc_id", timestamps.utc_iso(F.col("_dt")).alias("utc"))


@query
def review_articles(spark, sf):
    c = views.clustered(spark, sf).select("doc_id", "cluster", "source", "published", "title", "summary", "url")
    return reports.review_order(c)


# --- landed formats --------------------------------------------------------------------------------------------------


@query
def json_array_scan(spark, sf):
    """Each article as a landed file with a one-record JSON array, read back with an unknown key passed through."""
    a = views.articles(spark, sf)
    record = F.struct("title", "summary", "url", "source", F.col("doc_id").alias("ref"))
    day = F.date_format("dt", "yyyy-MM-dd")
    name = F.concat(F.lit("n12_rss_"), day, F.lit(".json"))
    files = a.select(F.to_json(F.array(record)).alias("value"), name.alias("_file"))
    rows = json_files.explode_arrays(files)
    return rows.select(
        F.col("extra")["ref"].cast("long").alias("doc_id"),
        "title",
        "summary",
        "url",
        "source",
        json_files.file_day(F.col("_file")).alias("dt"),
        "_pos",
    )


def _rss_items(spark, sf) -> DataFrame:
    """Each article as the XML text of an RSS item, parsed back into its fields."""
    a = views.articles(spark, sf)

    def tag(name: str, value: Column) -> Column:
        safe = F.replace(F.replace(value, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
        return F.when(value.isNotNull(), F.concat(F.lit(f"<{name}>"), safe, F.lit(f"</{name}>"))).otherwise("")

    fields = (("title", "title"), ("link", "url"), ("pubDate", "published"), ("description", "summary"))
    item = F.concat(F.lit("<item>"), *[tag(n, F.col(c)) for n, c in fields], F.lit("</item>"))
    parsed = a.select("doc_id", "scraped_at", F.from_xml(item, RSS_ITEM.simpleString()).alias("x"))
    return parsed.select("doc_id", "scraped_at", "x.*")


@query
def rss_n12_articles(spark, sf):
    return feeds.n12_articles(_rss_items(spark, sf), F.col("scraped_at"))


@query
def rss_kan11_articles(spark, sf):
    return feeds.kan11_articles(_rss_items(spark, sf), F.col("scraped_at"))


@query
def page_headlines(spark, sf):
    pages = views.table(spark, sf, "pages")
    return html_pages.extract_headlines(pages).select("page_id", "pos", "title", "summary", "url", "published")
