"""Landed files in, result files out."""

import json

import pytest
from pyspark.sql import functions as F

from pressloom.operators import dedup, records, reports
from pressloom.plans import pipelines
from pressloom.schemas import ARTICLE_FIELDS
from pressloom.sinks import writers
from pressloom.sources import feeds, html_pages, json_files, tables

# (published, published_iso) of one landed day, scraped at 2025-08-25T18:57:06+03:00.
LANDED_DAY = [
    ("", ""),
    ("לפני 18 דקות", "2025-08-25T18:39:06+03:00"),
    ("לפני 10 דקות", "2025-08-25T18:47:06+03:00"),
    ("לפני כשעה", "2025-08-25T17:57:06+03:00"),
    ("לפני כשעה", "2025-08-25T17:57:06+03:00"),
    ("לפני שעתיים", "2025-08-25T17:57:06+03:00"),
    ("לפני כשעה", "2025-08-25T17:57:06+03:00"),
    ("לפני כשעה", "2025-08-25T17:57:06+03:00"),
    ("לפני 48 דקות", "2025-08-25T18:09:06+03:00"),
    ("לפני כשעה", "2025-08-25T17:57:06+03:00"),
    ("לפני 29 דקות", "2025-08-25T18:28:06+03:00"),
    ("לפני כשעה", "2025-08-25T17:57:06+03:00"),
    ("לפני 9 דקות", "2025-08-25T18:48:06+03:00"),
    ("לפני שעתיים", "2025-08-25T17:57:06+03:00"),
]


def article(i, **other):
    base = {
        "title": f"כותרת {i}",
        "summary": "s",
        "url": f"https://www.c14.co.il/article/{i}",
        "published": "",
        "published_iso": "",
        "source": "c14",
        "scraped_at": "2025-08-25T18:57:06+03:00",
    }
    return base | other


def dump(path, payload):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(payload if isinstance(payload, str) else json.dumps(payload, ensure_ascii=False), encoding="utf-8")


def test_adapter_round_trip(spark, tmp_path):
    raw = [article(i, published=p) for i, (p, _) in enumerate(LANDED_DAY)]
    dump(tmp_path / "raw/c14_scraped_2025-08-25.json", raw)
    adapted = records.adapt(json_files.read_scraped(spark, str(tmp_path / "raw")))
    rows = adapted.orderBy("_pos").collect()
    assert [(r.published, r.published_iso) for r in rows] == LANDED_DAY
    assert [r.title for r in rows] == [a["title"] for a in raw]
    assert str(rows[0].dt) == "2025-08-25"


def test_daily_files(spark, tmp_path):
    day = "2025-08-25"
    dump(tmp_path / f"adapted/c14_adapted_{day}.json", [article(1), article(2), article(1, title="later", extra=5)])
    dump(tmp_path / f"raw/n12_rss_{day}.json", [article(1, source=" C14 ", title="from the other feed"), article(9)])
    dump(tmp_path / "raw/n12_rss_2025-08-26.json", [article(1)])
    dump(tmp_path / "raw/n12_rss_2025-08-27.json", '[{"title": "cut off')
    dump(tmp_path / "raw/n12_rss_2025-08-28.json", {"title": "not a list"})
    dump(tmp_path / "raw/n12_rss_latest.json", [article(77)])
    dump(tmp_path / f"raw/kan11_rss_{day}.json", [article(78)])
    loaded = json_files.read_daily_inputs(spark, str(tmp_path / "adapted"), str(tmp_path / "raw"))
    assert loaded.count() == 6
    extra = [r.extra for r in loaded.collect() if r.extra]
    assert extra == [{"extra": "5"}]
    processed = pipelines.daily(loaded)
    kept = {(str(r.dt), r.record_key, r.title) for r in processed.collect()}
    assert kept == {
        (day, "c14:1", "כותרת 1"),
        (day, "c14:2", "כותרת 2"),
        (day, "c14:9", "כותרת 9"),
        ("2025-08-26", "c14:1", "כותרת 1"),
    }
    out = str(tmp_path / "processed")
    writers.write_days(processed, out)
    writers.write_days(processed.where("dt = '2025-08-26'").withColumn("title", F.lit("again")), out)
    back = tables.read_processed_day(spark, out, day)
    assert sorted(r.title for r in back.collect()) == ["כותרת 1", "כותרת 2", "כותרת 9"]
    assert [r.title for r in tables.read_processed_day(spark, out, "2025-08-26").collect()] == ["again"]


def test_article_folder(spark, tmp_path):
    dump(tmp_path / "a.json", [article(1), article(2)])
    dump(tmp_path / "b.json", {"records": [article(3)], "note": "x"})
    dump(tmp_path / "c.json", "broken")
    dump(tmp_path / "d.jsonl", json.dumps(article(4)) + "\n\n" + json.dumps(article(5)) + "\nbroken\n")
    rows = json_files.read_articles(spark, str(tmp_path)).orderBy("_file", "_pos").collect()
    assert [r.title for r in rows] == [f"כותרת {i}" for i in (1, 2, 3, 4, 5)]


def test_stopwords_and_csv(spark, tmp_path):
    dump(tmp_path / "stop.txt", "word\n\n# note\n של \nword\n")
    words = tables.read_stopwords(spark, str(tmp_path / "stop.txt"))
    assert sorted(r.word for r in words.collect()) == ["word", "של"]
    dump(tmp_path / "c.csv", '\ufeffcluster,title\n1,"a ""b""\nnext"\n')
    df = tables.read_clustered_csv(spark, str(tmp_path / "c.csv"))
    assert df.columns == ["cluster", "title"]
    assert [tuple(r) for r in df.collect()] == [("1", 'a "b"\nnext')]


def test_rss(spark, tmp_path):
    dump(
        tmp_path / "feed.xml",
        """<?xml version="1.0"?><rss><channel><title>feed</title>
        <item><title>One &amp; two</title><link>http://x/1</link><pubDate>Sun, 24 Aug 2025 15:41:39 +0300</pubDate>
        <shortDescription>short</shortDescription><description>long</description></item>
        <item><title>Three</title><description>only</description></item></channel></rss>""",
    )
    items = feeds.read_rss_items(spark, str(tmp_path / "feed.xml"))
    now = F.lit("2025-08-24T16:00:00+03:00")
    n12 = {r.title: (r.summary, r.url, r.published_iso, r.source) for r in feeds.n12_articles(items, now).collect()}
    assert n12 == {
        "One & two": ("short", "http://x/1", "2025-08-24T15:41:39+03:00", "n12"),
        "Three": ("only", "", "", "n12"),
    }
    kan = {r.title: (r.summary, r.published_iso) for r in feeds.kan11_articles(items, now).collect()}
    assert kan == {"One & two": ("long", "2025-08-24T12:41:39"), "Three": ("only", None)}


PAGE = """<html><body><a href="/before">b</a>
<a href="/wrap"><h1> First <b>bold</b> </h1></a><p>one <i>i</i><p>two</p>
<h2>Second<!-- c -->part</h2><script>var x = "<p>no</p>";</script><div><p>three &amp; more<br>x</div>
<p>four</p><a>no target</a><a href="http://other/x">o</a>
<h2></h2><p><script>skip</script>five</p></body></html>"""


def test_page_headlines(spark):
    pages = spark.createDataFrame([(1, "https://site/base/", PAGE), (2, None, "<h1>x</h1>"), (3, "u", None)], "page_id long, url string, html string")
    rows = html_pages.extract_headlines(pages).orderBy("page_id", "pos").collect()
    got = [(r.page_id, r.pos, r.title, r.summary, r.url, r.published) for r in rows]
    # The first paragraph is not closed before the second one opens, so it holds the second one and what follows it
    # until its own end tag.
    assert got == [
        (1, 0, "Firstbold", "oneitwoSecondpartthree & morexfourno targetofive", "https://site/wrap", "two"),
        (1, 1, "Secondpart", "three & morex", "", "four"),
        (1, 2, "", "five", "", ""),
        (2, 0, "x", "", "", ""),
    ]


def test_page_cap(spark):
    html = "".join(f"<h2>t{i}</h2><p>s{i}</p>" for i in range(20))
    pages = spark.createDataFrame([(1, "https://s/", html)], "page_id long, url string, html string")
    assert html_pages.extract_headlines(pages, max_items=14).count() == 14
    every = html_pages.extract_headlines(pages, scraped_at=F.concat("url", F.lit("now"))).orderBy("pos").collect()
    assert {r.scraped_at for r in every} == {"now"}
    assert [(r.title, r.summary) for r in every] == [(f"t{i}", f"s{i}") for i in range(20)]


def clustered_rows(spark):
    rows = [
        (1, 1, "b", "T1", "2025-08-10T10:00:00"),
        (2, 1, "a", "T2", "2025-08-09T10:00:00.250000+00:00"),
        (3, 1, "", None, None),
        (4, 4, "a", "T4", "Sun, 24 Aug 2025 15:41:39 +0300"),
    ]
    df = spark.createDataFrame(rows, "_pos long, cluster long, source string, title string, published string")
    return df.withColumns({"summary": F.lit("s, \"q\"\nnext"), "url": F.concat(F.lit("u"), F.col("_pos").cast("string"))})


@pytest.mark.parametrize("save,folders", [("csv", 2), ("json", 1), ("both", 3)])
def test_cluster_run_files(spark, tmp_path, save, folders):
    df = records.with_instant(clustered_rows(spark))
    out = tmp_path / "run-1"
    params = {"threshold": 0.83, "stopwords": None, "date_from": ""}
    writers.write_cluster_run(pipelines.event_outputs(df), str(out), save, params)
    assert len(list(out.iterdir())) == folders + 1
    stats = spark.read.json(str(out / "run")).collect()[0]
    assert (stats.articles, stats.clusters, stats.singletons, stats.pct_singletons) == (4, 2, 1, 25.0)
    assert stats.params.asDict() == {"threshold": "0.83"}
    if save != "json":
        articles = tables.read_clustered_csv(spark, str(out / "articles"))
        assert articles.columns[:7] == list(reports.REVIEW_COLUMNS)
        assert {r.summary for r in articles.collect()} == {'s, "q"\nnext'}
        summary = tables.read_clustered_csv(spark, str(out / "clusters_summary")).collect()
        assert [tuple(r) for r in summary] == [("1", "3", "a, b", "T2"), ("4", "1", "a", "T4")]
    if save != "csv":
        lines = [r.asDict(recursive=True) for r in spark.read.json(str(out / "clusters")).orderBy("cluster").collect()]
        assert [(c["cluster"], c["size"], [i["url"] for i in c["items"]]) for c in lines] == [
            (1, 3, ["u2", "u1", "u3"]),
            (4, 1, ["u4"]),
        ]
    with pytest.raises(ValueError):
        writers.write_cluster_run({}, str(out), "xml")


def test_large_cluster_is_split_in_order(spark):
    rows = [(i, 7 if i % 3 else 100 + i, f"2025-08-{1 + i % 28:02d}T00:00:00" if i % 5 else None) for i in range(300)]
    df = spark.createDataFrame(rows, "_pos long, cluster long, published string")
    df = df.withColumns({c: F.lit("x") for c in ("source", "title", "summary")}).withColumn("url", F.col("_pos").cast("string"))
    nested = reports.nested_clusters(df, max_items=16)
    parts = [r for r in nested.collect() if r.cluster == 7]
    assert {(r.part, len(r["items"])) for r in parts} == {(k, 16) for k in range(12)} | {(12, 8)} and {r["size"] for r in parts} == {200}
    got = [i.url for r in sorted(parts, key=lambda r: r.part) for i in r["items"]]
    want = sorted((r for r in rows if r[1] == 7), key=lambda r: (r[2] is None, r[2] or "", r[0]))
    assert got == [str(r[0]) for r in want]
    assert sum(len(r["items"]) for r in nested.collect()) == 300
    placed = [reports.cluster_positions(df.repartition(n)).where("cluster = 7").orderBy("pos").collect() for n in (1, 9)]
    assert placed[0] == placed[1] and [r.pos for r in placed[0]] == list(range(200))


def test_postprocess(spark, tmp_path):
    grouped = [
        {"cluster_id": 1, "title": "short", "url": "u1", "source": "b", "published_dt": "2025-08-06T20:37:24.319230+00:00", "scraped_at": "2025-08-07"},
        {"cluster_id": 1, "title": "the longest", "url": "u2", "source": "a", "published_dt": "2025-08-06T20:37:24.319230+00:00", "scraped_at": "2025-08-07"},
        {"cluster_id": 1, "title": "late", "url": "u3", "source": "", "published_dt": "2025-08-08T00:00:00"},
        {"cluster_id": 2, "title": "undated", "url": "u4"},
        {"title": "no cluster", "url": "u5", "source": "a"},
    ]
    dump(tmp_path / "combined_grouped.json", grouped)
    fields = ("cluster_id", "title", "url", "source", "published_dt", "scraped_at")
    df = json_files.read_grouped(spark, str(tmp_path), fields).withColumn("cluster_id", F.col("cluster_id").cast("long"))
    out = pipelines.postprocess(df)
    assert [tuple(r) for r in out["clusters_summary"].collect()] == [
        (1, 3, "the longest", "u2", "a", ", a, b", "2025-08-06T20:37:24.319230+00:00", "2025-08-08T00:00:00+00:00"),
        (None, 1, "no cluster", "u5", "a", "a", "", ""),
        (2, 1, "undated", "u4", None, "", "", ""),
    ]
    assert [r.url for r in out["articles_by_cluster"].collect()] == ["u2", "u1", "u3", "u4", "u5"]
    metrics = out["metrics"].collect()[0]
    assert (metrics.articles, metrics.clusters, metrics.singletons) == (5, 3, 2)
    best = {r.cluster_id: r.url for r in reports.representatives(df).collect()}
    assert best == {1: "u2", 2: "u4", None: "u5"}


def test_missing_fields_are_filled(spark):
    full = records.with_columns(spark.range(2).withColumn("title", F.lit("t")), {"title": None, "url": "u", "source": None})
    assert [tuple(r) for r in full.collect()] == [(0, "t", "u", None), (1, "t", "u", None)]


def test_array_file_beyond_the_variant_limit(spark, tmp_path):
    """A file of about 150 MB, beyond what a VARIANT value can hold, is read completely."""
    record = json.dumps({"title": "t", "summary": "s" * 3_700, "url": "u"})
    (tmp_path / "n12_rss_2025-08-10.json").write_text("[" + ",".join([record] * 40_000) + "]")
    rows = json_files.read_feed_files(spark, str(tmp_path), "n12_rss_*.json")
    assert rows.agg(F.count("*"), F.max("_pos"), F.min(F.length("summary"))).collect()[0] == (40_000, 39_999, 3_700)


def test_preview_and_pull_field(spark):
    df = clustered_rows(spark)
    assert [r.published for r in records.pull_field(df).collect()] == [r.published for r in df.collect()]
    assert [r.url for r in reports.preview(df, "cluster").collect()] == ["u2", "u1", "u3", "u4"]
    order = dedup.arrival_order(df)
    assert [r.url for r in reports.cluster_samples(df, order, k=2).orderBy("_pos").collect()] == ["u1", "u2", "u4"]


def test_counts_come_from_the_run_that_writes(spark, tmp_path):
    """One look at the source: what is read and what is kept are counted on the way, by day in one pass as well."""
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    from pressloom.operators import dedup, reports

    spark.range(300).selectExpr("id AS _pos", "concat('k', id % 70) AS record_key", "if(id % 70 < 9, NULL, date'2025-08-11') AS dt").repartition(5).write.parquet(str(tmp_path / "in"))
    seen = spark.sparkContext.accumulator(0)
    source = spark.read.parquet(str(tmp_path / "in"))

    def look(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    loaded, kept = Observation(), Observation()
    read = reports.counted(source.mapInArrow(look, source.schema), loaded)
    writers.write_days(dedup.keep_first_by_record_key(read), str(tmp_path / "out"), written=kept)
    assert seen.value == 300
    assert (loaded.get, kept.get) == ({"rows": 300, "undated": 45}, {"rows": 70, "undated": 9})
    plan = reports.stage_counts(source)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and "Join" not in plan
    by_day = {r["dt"] and str(r["dt"]): (r["loaded"], r["kept"]) for r in reports.stage_counts(source).collect()}
    assert by_day == {None: (45, 9), "2025-08-11": (255, 61)}
    assert reports.stage_counts(source.where(F.lit(False))).collect() == []


def test_places_do_not_depend_on_ranges(spark):
    """A value that most rows share is cut into ranges like any other."""
    from pyspark.sql import functions as F

    from pressloom.operators import reports

    rows = spark.range(2000).selectExpr("if(id % 5 > 0, NULL, id % 7) AS _dt", "id AS _pos").repartition(7)
    for parts in ("1", "9"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = reports.running_places(rows, [F.asc_nulls_first("_dt"), F.col("_pos")]).collect()
        want = sorted(((r["_dt"] is not None, r["_dt"] or 0, r["_pos"]) for r in got))
        assert [(r["_dt"] is not None, r["_dt"] or 0, r["_pos"]) for r in sorted(got, key=lambda r: r["place"])] == want
        assert sorted(r["place"] for r in got) == list(range(1, 2001))
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_landed_files_grow_with_the_rows(spark, tmp_path):
    """Rows whose neighbours all have other file names make about one file per FILE_DOCS rows, and all come back."""
    from pressloom.plans import landed

    rows = spark.range(3000).selectExpr("id AS doc_id", "id AS _pos", "string(id % 3) AS k", "'t' AS title")
    folder = str(tmp_path / "dealt")
    landed._land_dealt(rows, F.concat(F.lit("f_"), "k", F.lit(".json")), folder, ("title", "doc_id"))
    files = sorted(p.name for p in (tmp_path / "dealt").rglob("*.json") if p.is_file())
    assert len(files) == 6 and set(files) == {"f_0.json", "f_1.json", "f_2.json"}
    back = json_files.read_grouped(spark, folder, ("title", "doc_id"))
    assert sorted(int(r["doc_id"]) for r in back.collect()) == list(range(3000))
    assert all(int(r["doc_id"]) % 3 == int(r["_file"][2]) for r in back.collect())
