"""Cluster sizes, summaries, representatives, samples and data-quality tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from pressloom.functions.text import blank_if_null
from pressloom.functions.timestamps import parse_instant, utc_iso
from pressloom.operators.dedup import arrival_order
from pressloom.session import StepTables

REVIEW_COLUMNS = ("cluster", "cluster_size", "source", "published", "title", "summary", "url")
ITEM_COLUMNS = ("source", "title", "summary", "url", "published")


def cluster_sizes(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    return df.groupBy(cluster).agg(F.count("*").alias("cluster_size"))


def with_cluster_size(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Sizes joined back to the articles; the sizes are partial sums, one row per cluster."""
    sizes = cluster_sizes(df, cluster).withColumnRenamed(cluster, "_cluster")
    return df.join(sizes, F.col(cluster).eqNullSafe(F.col("_cluster")), "left").drop("_cluster")


def run_stats(df: DataFrame, cluster: str = "cluster", denominator: str = "articles") -> DataFrame:
    """One row: articles, clusters, singletons and the singleton percentage of `articles` or of `clusters`."""
    total = {"articles": F.coalesce(F.sum("cluster_size"), F.lit(0)), "clusters": F.count("*")}[denominator]
    singles = F.count(F.when(F.col("cluster_size") == 1, 1))
    return cluster_sizes(df, cluster).agg(
        F.coalesce(F.sum("cluster_size"), F.lit(0)).alias("articles"),
        F.count("*").alias("clusters"),
        singles.alias("singletons"),
        (singles / F.greatest(total, F.lit(1)) * 100.0).alias("pct_singletons"),
    )


def _in_frame_order(df: DataFrame) -> Column:
    """Undated first, then by time, then by arrival: NULL sorts first inside a struct."""
    arrival = [c for c in ("_file_rank", "_file", "_pos") if c in df.columns]
    return F.struct("_dt", *arrival)


def run_summary(df: DataFrame, cluster: str = "cluster", max_sources: int = 5) -> DataFrame:
    """Per cluster: size, the first `max_sources` outlets by name, and the oldest title as an example."""
    names = F.array_sort(F.collect_set(F.when(F.col("source") != "", F.col("source"))))
    return df.groupBy(cluster).agg(
        F.count("*").alias("cluster_size"),
        F.array_join(F.slice(names, 1, max_sources), ", ").alias("sources"),
        F.min_by("title", F.when(F.col("title").isNotNull(), _in_frame_order(df))).alias("example_title"),
    )


def by_size(summary: DataFrame, size: str = "cluster_size", cluster: str = "cluster") -> DataFrame:
    return summary.orderBy(F.desc(size), F.asc(cluster))


def review_order(df: DataFrame) -> DataFrame:
    """Articles with their cluster size, the columns for a quick review first."""
    sized = with_cluster_size(df)
    first = [c for c in REVIEW_COLUMNS if c in sized.columns]
    rest = [c for c in sized.columns if c not in first and not c.startswith("_")]
    return sized.select(*first, *rest)


def cluster_positions(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    """(cluster, size, pos, item columns): each article's place in its cluster by `published` as text, absent last.

    The articles are range-partitioned by cluster and order and written down in that order with a running number; a place
    is that number less the first one of the cluster in the range, plus what the earlier ranges hold.  So no task gets a
    large cluster as a whole, and the places do not depend on the partitions.
    """
    arrival = [c for c in ("_file_rank", "_file", "_pos") if c in df.columns]
    order = [F.col("cluster"), F.col("published").isNull(), F.col("published"), *[F.col(c) for c in arrival]]
    rows = df.withColumn("cluster", F.col(cluster)).select("cluster", *ITEM_COLUMNS, *arrival)
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    ranged = StepTables(df.sparkSession, "items").save(ranged.withColumn("_range", F.shiftright("_at", 33)), "ranged")
    heads = ranged.groupBy("cluster", "_range").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    earlier = Window.partitionBy("cluster").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    heads = heads.withColumns(
        {
            "_before": F.coalesce(F.sum("_n").over(earlier), F.lit(0)),
            "size": F.sum("_n").over(Window.partitionBy("cluster")),
        }
    ).withColumnRenamed("cluster", "_cluster")
    same = F.col("cluster").eqNullSafe(F.col("_cluster")) & (ranged["_range"] == heads["_range"])
    pos = (F.col("_at") - F.col("_first") + F.col("_before")).alias("pos")
    return ranged.join(heads, same).select("cluster", "size", pos, *ITEM_COLUMNS)


def nested_clusters(df: DataFrame, cluster: str = "cluster", max_items: int = 10_000) -> DataFrame:
    """(cluster, size, part, items): lists of at most `max_items` articles of a cluster, in order of part.

    Part k holds the places from k * max_items on, for clusters of every size, so each row has a bounded length.
    """
    placed = cluster_positions(df, cluster).withColumn("part", F.floor(F.col("pos") / F.lit(max_items)))
    ordered = F.array_sort(F.collect_list(F.struct("pos", F.struct(*ITEM_COLUMNS).alias("item"))))
    grouped = placed.groupBy("cluster", "size", "part").agg(ordered.alias("_all"))
    return grouped.select("cluster", "size", "part", F.col("_all.item").alias("items"))


def post_summary(df: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    """Per cluster: size, the representative article, all outlets, first and last publication.

    The representative was published first, then scraped first, then has the longest title; unknown times come last.
    """
    arrival = [c for c in ("_file_rank", "_file", "_pos") if c in df.columns]
    timed = df.withColumns(
        {"_pub": parse_instant(F.col("published_dt")), "_scr": parse_instant(F.col("scraped_at"))}
    )
    order = F.struct(
        F.col("_pub").isNull().alias("p0"),
        F.col("_pub").alias("p1"),
        F.col("_scr").isNull().alias("s0"),
        F.col("_scr").alias("s1"),
        (-F.coalesce(F.char_length("title"), F.lit(0))).alias("len"),
        *arrival,
    )
    best = F.min_by(F.struct("title", "url", "source"), order)
    grouped = timed.groupBy(cluster).agg(
        F.count("*").alias("size"),
        best.alias("_r"),
        F.array_join(F.array_sort(F.collect_set("source")), ", ").alias("sources"),
        utc_iso(F.min("_pub")).alias("first_published_dt"),
        utc_iso(F.max("_pub")).alias("last_published_dt"),
    )
    return grouped.select(
        cluster,
        "size",
        F.col("_r.title").alias("repr_title"),
        F.col("_r.url").alias("repr_url"),
        F.col("_r.source").alias("repr_source"),
        "sources",
        "first_published_dt",
        "last_published_dt",
    )


def representatives(df: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    """The representative article of each cluster as a whole row."""
    from pressloom.operators.dedup import first_per_key

    order = [
        parse_instant(F.col("published_dt")).asc_nulls_last(),
        parse_instant(F.col("scraped_at")).asc_nulls_last(),
        F.desc(F.coalesce(F.char_length("title"), F.lit(0))),
        *arrival_order(df),
    ]
    return first_per_key(df, [cluster], order)


def articles_by_cluster(df: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    """All articles ordered by cluster, then publication (unknown last), outlet and URL; a range-partitioned sort."""
    order = [
        F.asc_nulls_last(cluster),
        parse_instant(F.col("published_dt")).asc_nulls_last(),
        F.asc_nulls_last("source"),
        F.asc_nulls_last("url"),
        *arrival_order(df),
    ]
    return df.orderBy(*order).select(cluster, "title", "summary", "url", "source", "published_dt", "scraped_at")


def source_spread(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Per cluster: size and number of outlets."""
    return df.groupBy(cluster).agg(
        F.count("*").alias("cluster_size"), F.count_distinct("source").alias("n_sources")
    )


def multi_source_share(spread: DataFrame, min_sources: int = 2) -> DataFrame:
    """One row: percentage of clusters with several outlets, and of articles inside such clusters."""
    multi = F.col("n_sources") >= min_sources
    return spread.agg(
        (F.avg(multi.cast("int")) * 100).alias("pct_clusters_multi"),
        (F.sum(F.when(multi, F.col("cluster_size")).otherwise(0)) / F.sum("cluster_size") * 100).alias(
            "pct_articles_multi"
        ),
    )


def multi_source_articles(df: DataFrame, cluster: str = "cluster", min_sources: int = 2) -> DataFrame:
    """Articles of the clusters with several outlets."""
    several = source_spread(df, cluster).where(F.col("n_sources") >= min_sources).select(cluster)
    return df.join(several, cluster, "left_semi")


def top_clusters(sizes: DataFrame, k: int = 10, by: Sequence[str] = ("cluster_size",), cluster: str = "cluster") -> DataFrame:
    return sizes.orderBy(*[F.desc(c) for c in by], F.asc(cluster)).limit(k)


def cluster_samples(
    df: DataFrame, order: Sequence[Column], cluster: str = "cluster", k: int = 3, title_chars: int | None = 200
) -> DataFrame:
    """The first `k` articles of each cluster; titles shortened for display unless `title_chars` is None."""
    rn = F.row_number().over(Window.partitionBy(cluster).orderBy(*order))
    picked = df.withColumn("sample_rank", rn).where(F.col("sample_rank") <= k)
    return picked.withColumn("title", F.substring("title", 1, title_chars)) if title_chars else picked


def preview(df: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    """Articles sorted by cluster and publication text, for reading through."""
    cols = [c for c in (cluster, "published", "source", "title", "summary", "url") if c in df.columns]
    order = [F.asc_nulls_last(c) for c in (cluster, "published") if c in cols]
    return df.orderBy(*order, *arrival_order(df)).select(*cols)


def top_summaries(df: DataFrame, k: int = 20) -> DataFrame:
    """The `k` most repeated (source, summary) pairs."""
    counted = df.groupBy("source", blank_if_null(F.col("summary")).alias("summary")).agg(F.count("*").alias("n"))
    return counted.orderBy(F.desc("n"), "source", "summary").limit(k)


def stage_counts(loaded: DataFrame, day: str = "dt", key: str = "record_key") -> DataFrame:
    """Rows per day before and after duplicates are dropped, in one pass: a row per key and day is what is kept."""
    per_key = loaded.groupBy(day, key).agg(F.count("*").alias("n"))
    return per_key.groupBy(day).agg(F.sum("n").alias("loaded"), F.count("*").alias("kept"))


def counted(df: DataFrame, seen: Observation, day: str = "dt") -> DataFrame:
    """`df`, with its `rows` and `undated` rows counted into `seen` by whatever job reads it.

    The counts cost no job and no second look at the input.  Put it where the rows pass once: on what is read, or behind the
    last exchange, since a range partitioning looks at its input twice.
    """
    return df.observe(seen, F.count("*").alias("rows"), F.count(F.when(F.col(day).isNull(), 1)).alias("undated"))


def running_places(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """Adds `place`, from 1 on, in the order of the given columns, which must be total.

    Rows are range-partitioned, sorted and written down with a running number; a place is that number less the first one of
    its range, plus what the earlier ranges hold.  No task gets more than a range, whatever values repeat, and the windows
    run over one row per range.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    ranged = StepTables(df.sparkSession, "places").save(ranged.withColumn("_range", F.shiftright("_at", 33)), "ranged")
    heads = ranged.groupBy("_range").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))  # one row per range
    heads = heads.select("_range", "_first", F.coalesce(before, F.lit(0)).alias("_before"))
    place = F.col("_at") - F.col("_first") + F.col("_before") + 1
    return ranged.join(F.broadcast(heads), "_range").select(*df.columns, place.alias("place"))
