"""Queries over landed files: the article view is written through a sink to the shared folder and read back by a source."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from pressloom.functions import timestamps
from pressloom.operators import dedup, features, records, reports
from pressloom.plans import pipelines, views
from pressloom.schemas import ARTICLE_FIELDS
from pressloom.session import StepTables
from pressloom.sinks import writers
from pressloom.sources import feeds, html_pages, json_files, tables

DAY = "2025-08-12"
STOPWORDS = ("the", "and", "of", "to", "in", "la", "de")
FEED_FIELDS = ("title", "summary", "url", "source", "published", "scraped_at")


def _folder(spark, name: str) -> str:
    return StepTables(spark, name).folder()


FILE_DOCS = 500
#: Folders of files that get their names at a time.
RENAMES = 16


def _land_texts(rows: DataFrame, folder: str) -> None:
    """Write (bucket, name, value) as one text file each, its name in the folder's name; a file has a bounded size.

    The tasks move their files into place themselves, as the driver would move them one after the other.
    """
    writer = rows.repartition("bucket", "name").write.mode("overwrite").option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    writer.partitionBy("bucket", "name").text(folder)


def _land_named(rows: DataFrame, folder: str) -> None:
    """As `_land_texts`, and each file gets its name; the files of one name stand in different folders."""
    _land_texts(rows, folder)
    spark = rows.sparkSession
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def name_files(bucket) -> None:
        files = fs.listFiles(bucket, True)
        while files.hasNext():
            path = files.next().getPath()
            if path.getName().startswith("part-"):
                place = path.getParent()
                fs.rename(path, spark._jvm.org.apache.hadoop.fs.Path(place, place.getName().partition("=")[2]))

    with ThreadPoolExecutor(RENAMES) as pool:
        list(pool.map(name_files, [found.getPath() for found in fs.listStatus(root) if found.isDirectory()]))


def _dealt(rows: DataFrame, name: Column) -> DataFrame:
    """The rows of each name with `_bucket`, dealt by document number into about as many files as hold FILE_DOCS records each.

    So the files grow in number with the rows, however many names stand side by side; only the counts per name are joined.
    """
    named = rows.withColumn("_name", name)
    files = named.groupBy("_name").agg(F.ceil(F.count("*") / FILE_DOCS).alias("_files"))
    dealt = named.join(files, "_name", "left")
    return dealt.withColumn("_bucket", F.pmod(F.xxhash64("doc_id"), F.coalesce("_files", F.lit(1))))


def _packed(rows: DataFrame, name: Column, fields=(*FEED_FIELDS, "doc_id"), wrap: str | None = None, bucket: Column | None = None) -> DataFrame:
    """(bucket, name, value): some FILE_DOCS records of a name as a JSON array, or as an object that holds it; without a
    `bucket` the records of a file are those of FILE_DOCS neighbouring document numbers."""
    record = F.struct(*fields)
    bucket = F.expr(f"doc_id div {FILE_DOCS}") if bucket is None else bucket
    packed = rows.groupBy(bucket.alias("bucket"), name.alias("name")).agg(F.array_sort(F.collect_list(F.struct("_pos", record.alias("r")))).alias("all"))
    listed = F.col("all.r")
    return packed.select("bucket", "name", F.to_json(F.struct(listed.alias(wrap)) if wrap else listed).alias("value"))


def _land_dealt(rows: DataFrame, name: Column, folder: str, fields=(*FEED_FIELDS, "doc_id")) -> None:
    """Named files of some FILE_DOCS records each, where the place of a record in its file does not matter."""
    _land_named(_packed(_dealt(rows, name), F.col("_name"), fields, bucket=F.col("_bucket")), folder)


def _by_folder(spark, folder: str, file: Column) -> DataFrame:
    """Landed texts with the file name that stands in their folder's name."""
    files = spark.read.text(folder, wholetext=True)
    return files.select("value", file.alias("_file"))


def landed_feed_files(spark, sf):
    """Raw arrays by feed and day, those without a day in the name left out; positions inside each file."""
    a = views.articles(spark, sf)
    day = F.when(F.col("doc_id") % 7 == 0, F.lit("undated")).otherwise(F.date_format("dt", "yyyy-MM-dd"))
    folder = _folder(spark, "feeds")
    _land_named(_packed(a, F.concat(F.lit("n12_rss_"), day, F.lit(".json"))), folder)
    rows = json_files.read_feed_files(spark, folder, "n12_rss_*.json")
    return rows.select(F.col("extra")["doc_id"].cast("long").alias("doc_id"), "title", "url", "published", "dt", "_pos")


def landed_json_lines(spark, sf):
    """A folder of JSON lines, with blank lines and lines that are not JSON in between."""
    a = views.articles(spark, sf)
    line = F.to_json(F.struct(*FEED_FIELDS, "doc_id"))
    noise = F.when(F.col("doc_id") % 3 == 0, F.lit("{broken")).when(F.col("doc_id") % 3 == 1, F.lit("  ")).otherwise(F.lit("[1]"))
    folder = _folder(spark, "lines")
    a.select(F.explode(F.array(line, noise)).alias("value")).write.text(folder)
    rows = json_files.read_json_lines(spark, folder, ARTICLE_FIELDS, pattern="part-*")
    return rows.select(F.col("extra")["doc_id"].cast("long").alias("doc_id"), "title", "summary", "url", "source", "published")


def landed_wrapped_files(spark, sf):
    """Arrays and objects that hold the array under `records`, together."""
    a = views.articles(spark, sf)
    name = F.concat(F.lit("c14_scraped_"), F.date_format("dt", "yyyy-MM-dd"), F.lit(".json"))
    plain, wrapped = a.where("doc_id % 2 = 0"), a.where("doc_id % 2 = 1")
    one, two = _folder(spark, "plain"), _folder(spark, "wrapped")
    _land_texts(_packed(plain, name), one)
    _land_texts(_packed(wrapped, name, wrap="records"), two)
    files = _by_folder(spark, one, F.col("name")).unionByName(_by_folder(spark, two, F.col("name")))
    rows = json_files.explode_arrays_or_wrapped(files)
    return rows.select(F.col("extra")["doc_id"].cast("long").alias("doc_id"), "title", "source", "scraped_at", "_pos")


def landed_processed_day(spark, sf):
    """The processed table of all days, one day written again with fewer rows, and that day read back."""
    processed = pipelines.daily(views.articles(spark, sf)).withColumn("_file", F.lit("f")).withColumn("_file_rank", F.lit(0))
    folder = _folder(spark, "processed")
    writers.write_days(processed.drop("doc_id"), folder)
    writers.write_days(processed.where(f"dt = '{DAY}' AND _pos % 2 = 0").drop("doc_id"), folder)
    day = tables.read_processed_day(spark, folder, DAY)
    return day.select(F.col("_pos").alias("doc_id"), "title", "url", "source", "record_key", "dt")


def landed_processed_other_days(spark, sf):
    """After the same two writes, what the untouched days hold."""
    processed = pipelines.daily(views.articles(spark, sf)).withColumn("_file", F.lit("f")).withColumn("_file_rank", F.lit(0))
    folder = _folder(spark, "processed")
    writers.write_days(processed.drop("doc_id"), folder)
    writers.write_days(processed.where(f"dt = '{DAY}' AND _pos % 2 = 0").drop("doc_id"), folder)
    return spark.read.json(folder).groupBy(F.col("dt").cast("date").alias("dt")).agg(F.count("*").alias("articles"), F.count_distinct("record_key").alias("keys"))


def landed_adapted(spark, sf):
    """The adapted table by day and source."""
    e = views.labelled_events(spark, sf).withColumnRenamed("label", "published").withColumn("_pos", F.col("event_id"))
    adapted = records.adapt(e).withColumn("dt", F.to_date(F.substring("scraped_at", 1, 10)))
    adapted = adapted.withColumn("source", F.concat(F.lit("s"), (F.col("event_id") % 3).cast("string")))
    folder = _folder(spark, "adapted")
    writers.write_days(adapted, folder, keys=("dt", "source"))
    back = spark.read.json(folder)
    return back.select("event_id", "published", "published_iso", "source", F.col("dt").cast("date").alias("dt"))


def landed_raw(spark, sf):
    """The raw table by day, as it was fetched."""
    folder = _folder(spark, "raw")
    writers.write_days(views.articles(spark, sf).select(*ARTICLE_FIELDS, "dt", "_pos"), folder)
    back = spark.read.json(folder)
    return back.select(F.col("_pos").alias("doc_id"), "title", "summary", "published", "scraped_at", F.col("dt").cast("date").alias("dt"))


def _run_folder(spark, sf, save: str = "both") -> str:
    c = records.with_instant(views.clustered(spark, sf).drop("cluster_id", "published_dt"))
    folder = _folder(spark, "run")
    writers.write_cluster_run(pipelines.event_outputs(c), folder, save, {"threshold": 0.83, "stopwords": None})
    return folder


def landed_clustered_csv(spark, sf):
    """The articles of a clustering run as CSV with line breaks inside fields, read back."""
    back = tables.read_clustered_csv(spark, f"{_run_folder(spark, sf, 'csv')}/articles")
    return back.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("cluster").cast("long").alias("cluster"), F.col("cluster_size").cast("long").alias("cluster_size"), "source", "title", "summary"
    )


def landed_cluster_summary_csv(spark, sf):
    back = tables.read_clustered_csv(spark, f"{_run_folder(spark, sf, 'csv')}/clusters_summary")
    return back.select(F.col("cluster").cast("long").alias("cluster"), F.col("cluster_size").cast("long").alias("cluster_size"), "sources", "example_title")


def landed_clusters_json(spark, sf):
    """The nested clusters of a run as JSON lines."""
    schema = "cluster long, size long, part long, items array<struct<source:string,title:string,summary:string,url:string,published:string>>"
    back = spark.read.schema(schema).json(f"{_run_folder(spark, sf, 'json')}/clusters")
    rows = back.select("cluster", "size", "part", F.posexplode("items").alias("pos", "item"))
    return rows.select("cluster", "size", "part", "pos", "item.source", "item.title", "item.url", "item.published")


def landed_run_stats(spark, sf):
    stats = spark.read.json(f"{_run_folder(spark, sf)}/run")
    return stats.select("articles", "clusters", "singletons", F.round("pct_singletons", 6).alias("pct_singletons"), F.col("params.threshold").alias("threshold"))


def _post(spark, sf) -> dict[str, DataFrame]:
    c = views.clustered(spark, sf)
    folder = _folder(spark, "grouped")
    fields = ("cluster_id", "title", "url", "source", "published_dt", "scraped_at", "doc_id")
    _land_dealt(c, F.concat(F.lit("combined_"), (F.col("cluster") % 10).cast("string"), F.lit(".json")), folder, fields)
    grouped = json_files.read_grouped(spark, folder, fields)
    grouped = grouped.withColumn("cluster_id", F.col("cluster_id").cast("long")).withColumn("_pos", F.col("doc_id").cast("long")).drop("_file")
    return pipelines.postprocess(grouped)


def landed_post_csv(spark, sf):
    """Grouped articles as JSON arrays, post-processed, the summary written as CSV and read back."""
    out = _folder(spark, "post")
    writers.write_csv(_post(spark, sf)["clusters_summary"], out)
    back = tables.read_clustered_csv(spark, out)
    return back.select(F.col("cluster_id").cast("long").alias("cluster_id"), F.col("size").cast("long").alias("size"), "repr_title", "repr_source")


def landed_post_articles_csv(spark, sf):
    """The article list of the same run, by cluster, as CSV read back."""
    out = _folder(spark, "post-articles")
    writers.write_csv(_post(spark, sf)["articles_by_cluster"], out)
    back = tables.read_clustered_csv(spark, out)
    return back.select(F.col("cluster_id").cast("long").alias("cluster_id"), "title", "url", "source", "published_dt", "scraped_at")


def landed_scraped(spark, sf):
    """Scraped files by day, read for the adapter, with their labels resolved."""
    e = views.labelled_events(spark, sf).select(F.col("event_id").alias("doc_id"), F.col("label").alias("published"), "scraped_at", F.col("event_id").alias("_pos"))
    rows = e.withColumns({c: F.lit(None).cast("string") for c in ("title", "summary", "url")}).withColumn("source", F.lit("c14"))
    folder = _folder(spark, "scraped")
    _land_dealt(rows, F.concat(F.lit("c14_scraped_"), F.substring("scraped_at", 1, 10), F.lit(".json")), folder)
    adapted = records.adapt(json_files.read_scraped(spark, folder))
    return adapted.select(F.col("extra")["doc_id"].cast("long").alias("event_id"), "published", "published_iso", "dt")


def landed_daily(spark, sf):
    """The daily run over landed files: adapted and raw arrays by day, read, processed, written by day and read back."""
    a = views.articles(spark, sf)
    day = F.concat(F.date_format("dt", "yyyy-MM-dd"), F.lit(".json"))
    adapted, raw = _folder(spark, "daily-adapted"), _folder(spark, "daily-raw")
    _land_dealt(a.where("doc_id % 2 = 0"), F.concat(F.lit("c14_adapted_"), day), adapted)
    _land_dealt(a.where("doc_id % 2 = 1"), F.concat(F.lit("n12_rss_"), day), raw)
    landed = json_files.read_daily_inputs(spark, adapted, raw).withColumn("_pos", F.col("extra")["doc_id"].cast("long"))
    folder = _folder(spark, "daily")
    writers.write_days(pipelines.daily(landed.drop("extra")), folder)
    back = spark.read.json(folder)
    return back.select(F.col("_pos").alias("doc_id"), "title", "url", "source", "record_key", F.col("dt").cast("date").alias("dt"), F.col("_file_rank").cast("int").alias("feed"))


def landed_rss(spark, sf):
    """Articles as RSS files, written and read by row tag, and taken in as raw articles."""
    a = views.articles(spark, sf)
    items = a.select("title", F.col("url").alias("link"), F.col("published").alias("pubDate"), F.lit(None).cast("string").alias("shortDescription"), F.col("summary").alias("description"))
    folder = _folder(spark, "rss")
    items.write.format("xml").option("rootTag", "channel").option("rowTag", "item").save(folder)
    return feeds.n12_articles(feeds.read_rss_items(spark, folder), F.lit("2025-08-24T12:00:00+03:00"))


def landed_dedup_json(spark, sf):
    """The legacy run: first row of each key, as JSON."""
    a = views.articles(spark, sf).withColumn("published_iso", F.col("published"))
    kept = dedup.keep_first_by_dedup_key(records.preprocess_legacy(a))
    folder = _folder(spark, "dedup")
    writers.write_days(kept.select("title", "url", "dedup_key", "dt", "_pos"), folder)
    return spark.read.json(folder).select(F.col("_pos").alias("doc_id"), "dedup_key", F.col("dt").cast("date").alias("dt"))


def landed_preview_csv(spark, sf):
    c = views.clustered(spark, sf)
    folder = _folder(spark, "preview")
    writers.write_csv(reports.preview(c, "cluster").select("cluster", "source", "title"), folder)
    back = tables.read_clustered_csv(spark, folder)
    return back.select(F.col("cluster").cast("long").alias("cluster"), "source", "title")


def landed_stopwords(spark, sf):
    """A stop-word file with comments, blanks and repeats, made from the most frequent source names and fixed words."""
    folder = _folder(spark, "stopwords")
    sources = views.table(spark, sf, "documents").select(F.explode(F.array(F.col("source"), F.concat(F.lit("# "), "source"), F.lit(""), F.concat(F.lit(" "), "source", F.lit(" ")))).alias("value"))
    sources.write.text(folder)
    return tables.read_stopwords(spark, folder)


def distinct_sources(spark, sf):
    return views.articles(spark, sf).select("source").where("source <> ''").distinct()


def union_of_feeds(spark, sf):
    """Two feeds of the same days as one, which share some rows: adapted before raw, so the adapted row is the first of its key."""
    a = views.articles(spark, sf)
    first = a.where("doc_id % 2 = 0").withColumn("_file_rank", F.lit(0))
    second = a.where("doc_id % 2 = 1 OR doc_id % 3 = 0").withColumn("_file_rank", F.lit(1)).withColumn("title", F.concat(F.lit("raw "), "title"))
    both = second.unionByName(first, allowMissingColumns=True)
    return pipelines.daily(both).select("doc_id", "dt", "title", F.col("_file_rank").alias("feed"))


def union_of_payloads(spark, sf):
    """Arrays, wrapped arrays and JSON lines in one folder's union."""
    parts = [landed_wrapped_files(spark, sf).select("doc_id", "title", "source"), landed_json_lines(spark, sf).select("doc_id", "title", "source")]
    return parts[0].unionByName(parts[1])


def default_columns(spark, sf):
    rows = views.table(spark, sf, "documents").select("doc_id", "source")
    return records.with_columns(rows, {"source": "none", "title": "", "url": None})


def pulled_field(spark, sf):
    return records.pull_field(views.articles(spark, sf))


def niqqud_titles(spark, sf):
    """Headlines between words with vowel points, in composed and decomposed forms, and their normal and minimal forms."""
    from pressloom.functions import text

    headline = F.coalesce(F.regexp_extract("text", r"\A[^.\n]*", 0), F.lit(""))
    pointed = F.concat(F.lit("שָׁלוֹם "), headline, F.when(F.col("doc_id") % 2 == 0, F.lit(" café")).otherwise(F.lit(" café")), F.lit(" מִלְחָמָה"))
    rows = views.table(spark, sf, "documents").select("doc_id", pointed.alias("title"))
    return rows.select("doc_id", text.normalize_text(F.col("title")).alias("normal"), text.norm_min(F.col("title")).alias("minimal"))


def _listing_pages(spark, sf) -> DataFrame:
    """Pages made of the texts of several documents, with more than fourteen headings, links and paragraphs each."""
    safe = lambda c: F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    title = safe(F.regexp_extract("text", r"\A[^.\n]*", 0))
    level = F.when(F.col("doc_id") % 2 == 0, "h1").otherwise("h2")
    part = F.concat(F.lit("<"), level, F.lit(">"), title, F.lit("</"), level, F.lit("><p>s"), "doc_id", F.lit("</p><p>לפני "), "doc_id", F.lit(" דקות</p><a href='/n/"), "doc_id", F.lit("'>x</a>"))
    docs = views.table(spark, sf, "documents").select((F.col("doc_id") % 40).alias("page_id"), "doc_id", part.alias("part"))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "part"))), lambda x: x["part"]), "")
    pages = docs.groupBy((F.floor(F.col("doc_id") / 4000) * 40 + F.col("page_id")).alias("page_id")).agg(listed.alias("html"))
    return pages.withColumn("url", F.lit("https://site.example/list"))


def _adapted_headlines(spark, sf) -> DataFrame:
    found = html_pages.extract_headlines(_listing_pages(spark, sf), scraped_at=F.lit("2025-08-24T15:41:39+03:00"))
    return records.adapt(found)


def daily_run(spark, sf):
    """The whole daily run: landed pages, headlines, adapted times, records without repeats, written by day and read back."""
    adapted = _adapted_headlines(spark, sf).withColumn("dt", F.to_date(F.substring("scraped_at", 1, 10)))
    placed = adapted.withColumns({"_file": F.col("page_id").cast("string"), "_file_rank": F.lit(0), "_pos": F.col("pos").cast("long")})
    folder = _folder(spark, "daily")
    writers.write_days(pipelines.daily(placed.drop("page_id", "pos")), folder)
    back = tables.read_processed_day(spark, folder, "2025-08-24")
    return back.select(F.col("_file").cast("long").alias("page_id"), "_pos", "title", "url", "published_iso", "source", "record_key", "dt")


def tfidf_stopword_table(spark, sf):
    """TF-IDF weights with the stop words as a table, which may have any length."""
    frame = pipelines.clustering_frame(views.articles(spark, sf))
    stop = spark.sql("SELECT * FROM VALUES " + ", ".join(f"('{w}')" for w in STOPWORDS) + " AS t(word)")
    return features.tfidf(frame, max_df=0.75, ngram_range=(1, 3), stopwords=stop).select("doc_id", "term", F.round("w", 6).alias("w"))


def many_headlines(spark, sf):
    return _adapted_headlines(spark, sf).select("page_id", "pos", "title", "summary", "url", "published", "published_iso")


def full_text_frame(spark, sf):
    """The clustering text from title and summary."""
    frame = pipelines.clustering_frame(views.articles(spark, sf), fields=("title", "summary"))
    return frame.select("doc_id", F.sha2("text_for_cluster", 256).alias("text_sha256"))


def ranked_in_time(spark, sf):
    """The time order with each row's rank, so that the order itself is in the result."""
    a = records.with_instant(views.articles(spark, sf))
    ranked = pipelines.ranked_in_time(a.select("doc_id", "_dt", *[c for c in dedup.ARRIVAL if c in a.columns]))
    return ranked.select("doc_id", timestamps.utc_iso(F.col("_dt")).alias("utc"), F.col("place").alias("rank"))


def observed_counts(spark, sf):
    """What the daily run has read and kept, counted while it writes its result."""
    loaded, kept = Observation(), Observation()
    processed = pipelines.daily(reports.counted(views.articles(spark, sf), loaded))
    writers.write_days(processed.drop("doc_id"), _folder(spark, "observed"), written=kept)
    rows = [("loaded", *loaded.get.values()), ("kept", *kept.get.values())]
    return spark.createDataFrame(rows, "stage string, rows long, undated long")


QUERIES = {
    fn.__name__: fn
    for fn in (
        landed_feed_files, landed_json_lines, landed_wrapped_files, landed_processed_day, landed_processed_other_days, landed_adapted, landed_raw, landed_clustered_csv,
        landed_cluster_summary_csv, landed_clusters_json, landed_run_stats, landed_post_csv, landed_dedup_json, landed_preview_csv, landed_stopwords, distinct_sources, union_of_feeds,
        union_of_payloads, daily_run, tfidf_stopword_table, default_columns, pulled_field, niqqud_titles, many_headlines, full_text_frame, ranked_in_time,
        observed_counts, landed_post_articles_csv, landed_scraped, landed_daily, landed_rss,
    )
}
