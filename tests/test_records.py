"""Record steps, duplicate rules and filters on literal rows."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pressloom.operators import dedup, records
from pressloom.plans import pipelines


def frame(spark, rows, schema):
    rows = [(i, *r) for i, r in enumerate(rows)]
    return spark.createDataFrame(rows, "_pos long, " + schema)


def test_adapt_blanks_what_is_no_label(spark):
    now = "2025-08-24T15:41:39+03:00"
    rows = [("לפני שעה", now), (" אתמול ", now), ("כותרת כתבה", now), (None, now), ("לפני שעה", None)]
    out = records.adapt(frame(spark, rows, "published string, scraped_at string")).orderBy("_pos").collect()
    assert [(r.published, r.published_iso) for r in out] == [
        ("לפני שעה", "2025-08-24T14:41:39+03:00"),
        ("אתמול", ""),
        ("", ""),
        ("", ""),
        ("לפני שעה", ""),
    ]


def test_preprocess_keeps_source_and_uses_raw_title(spark):
    rows = [(" C14 ", "HTTPS://C14.co.il/article/7/?x=1", "צפו: א  ב....", None)]
    out = records.preprocess(frame(spark, rows, "source string, url string, title string, summary string")).first()
    assert out.source == " C14 "
    assert (out.url, out.url_id, out.record_key) == ("https://c14.co.il/article/7", "7", "c14:7")
    assert (out.title, out.title_norm_min, out.summary, out.summary_norm_min) == ("צפו: א ב…", "א ב", "", "")


def keyed(spark, urls):
    df = frame(spark, [(u, "x") for u in urls], "url string, source string")
    return records.preprocess(df.withColumns({"title": F.lit("t"), "summary": F.lit("s"), "dt": F.lit("2025-08-10")}))


def test_first_by_record_key(spark):
    df = keyed(spark, ["https://ex.com/a", "https://ex.com/a", "https://ex.com/b", None, "", "http://EX.com/b/"])
    positions = lambda d: sorted(r._pos for r in d.collect())
    assert positions(dedup.keep_first_by_record_key(df)) == [0, 2, 3]
    assert positions(dedup.keep_first_by_record_key(df, keep_blank_urls=True)) == [0, 2, 3, 4]
    no_key = df.withColumn("record_key", F.when(F.col("_pos") > 2, "").otherwise(F.col("record_key")))
    assert positions(dedup.keep_first_by_record_key(no_key)) == [0, 2, 3, 4, 5]
    two_days = df.withColumn("dt", F.when(F.col("_pos") == 1, "2025-08-11").otherwise(F.col("dt")))
    assert positions(dedup.keep_first_by_record_key(two_days)) == [0, 1, 2, 3]


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.sampled_from(["https://ex.com/a", "https://ex.com/b?x=1", "", None, "u1"]), max_size=12))
def test_hygiene_is_idempotent(spark, urls):
    once = dedup.keep_first_by_record_key(keyed(spark, [*urls, "u"]))
    twice = dedup.keep_first_by_record_key(once)
    assert sorted(r._pos for r in once.collect()) == sorted(r._pos for r in twice.collect())


def test_latest_by_title(spark):
    rows = [
        ("a", "t", "2025-08-10T10:00:00"),
        ("a", "t", None),
        ("a", "t", "Sun, 10 Aug 2025 13:30:00 +0300"),
        ("b", "t", None),
        ("b", "t", "label"),
        ("a", "", "2025-08-12"),
    ]
    df = frame(spark, rows, "source string, title_norm_min string, published string")
    out = pipelines.clustering_frame(df)
    assert sorted(r._pos for r in out.collect()) == [2, 4]
    assert [r._pos for r in pipelines.clustering_frame(df, max_articles=1).collect()] == [4]


def test_legacy_dedup_key_and_url_rules(spark):
    df = frame(spark, [("k", "u"), ("k", "u"), (None, None), (None, ""), (None, "")], "dedup_key string, url string")
    assert sorted(r._pos for r in dedup.keep_first_by_dedup_key(df).collect()) == [0, 2]
    assert sorted(r._pos for r in dedup.keep_first_by_url(df).collect()) == [0, 2, 3, 4]
    assert sorted(r._pos for r in dedup.repeated_urls(df).collect()) == [0, 1, 3, 4]


def test_legacy_record_form(spark):
    rows = [
        ("תרבות", "x", "2025-08-19T10:00:00+00:00"),
        ("כותרת אמיתית", "  סיכום  ", "2025-08-19T12:34:56+00:00"),
        ("B", "  ", "bad-date"),
        ("C", None, None),
    ]
    df = frame(spark, rows, "title string, summary string, published_iso string")
    out = records.preprocess_legacy(df).orderBy("_pos").collect()
    assert [(r.title, r.summary, r.clean_title, r.published_iso, r.dedup_key) for r in out] == [
        ("כותרת אמיתית", "סיכום", "כותרת אמיתית", "2025-08-19T12:34:56+00:00", "כותרת אמיתית_2025-08-19"),
        ("B", "", "b", "", "b_no-date"),
        ("C", "", "c", "", "c_no-date"),
    ]


def test_boilerplate(spark):
    welcome = "תודה שקראתם אותנו היום"
    rows = [("s1", welcome)] * 5 + [("s1", f"סיכום {i}") for i in range(5)] + [("s2", welcome)] * 3
    rows += [("s3", "")] * 6 + [(None, welcome)] * 5
    out = records.drop_boilerplate(frame(spark, rows, "source string, summary string")).collect()
    kept = sorted((r.source or "", r.summary) for r in out)
    assert kept == sorted([("s1", f"סיכום {i}") for i in range(5)] + [("s2", welcome)] * 3 + [("s3", "")] * 6)


def test_title_filters(spark):
    df = frame(spark, [("אוכל",), ("קצר",), ("כותרת ארוכה יותר",), (None,)], "title string")
    assert sorted(r._pos for r in records.suspicious_titles(df).collect()) == [0, 1]
    assert sorted(r._pos for r in records.drop_section_titles(df).collect()) == [1, 2, 3]


def test_time_filters(spark):
    df = frame(spark, [("2025-08-10T23:59:59",), ("2025-08-11",), ("2025-08-12T06:00:00",), (None,)], "published string")
    df = records.with_instant(df)
    positions = lambda d: sorted(r._pos for r in d.collect())
    assert positions(records.in_date_range(df, "2025-08-11", "2025-08-12")) == [1, 2]
    assert positions(records.in_date_range(df, date_to="2025-08-10")) == [0]
    assert positions(records.in_last_days(df, "2025-08-12 10:00:00", 2)) == [1, 2]
    assert positions(records.in_last_hours(df, "2025-08-12 10:00:00", 34)) == [2]
    assert positions(records.in_last_hours(df, "2025-08-12 10:00:00", 35)) == [0, 1, 2]


def test_cluster_text(spark):
    df = frame(spark, [("צפו: א ב", "ג"), ("!!", "ד"), (None, None)], "title string, summary string")
    assert [r.text_for_cluster for r in records.with_cluster_text(df).collect()] == ["א ב"]
    both = records.with_cluster_text(df, ("title", "summary")).orderBy("_pos").collect()
    assert [r.text_for_cluster for r in both] == ["א ב ג", "ד"]


def test_keep_one_limits_rows_before_the_shuffle(spark):
    df = keyed(spark, ["https://ex.com/a"] * 5)
    plan = dedup.keep_first_by_record_key(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("rule", [dedup.keep_latest_by_title, dedup.keep_first_by_dedup_key, dedup.keep_first_by_url])
def test_other_rules_limit_too(spark, rule):
    cols = "_pos long, source string, title_norm_min string, _dt timestamp, dedup_key string, url string"
    plan = rule(spark.createDataFrame([], cols).union(spark.range(3).selectExpr("id", "'s'", "'t'", "timestamp'2025-01-01'", "'k'", "'u'")))
    assert plan._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2
