"""DuckDB SQL for the queries over landed files: what must come back, straight from the tables."""

from __future__ import annotations

from pressloom.plans.catalog_sql import _ARTICLES, _CANONICAL, _LABELS, _SECOND, _UTC, _clean, _norm_min, _normal, _sql, _weights
from pressloom.plans.landed import DAY, FILE_DOCS, STOPWORDS

_FIRST = "QUALIFY row_number() OVER (PARTITION BY {} ORDER BY {}) = 1"
_PLACE = f"row_number() OVER (PARTITION BY dt, doc_id // {FILE_DOCS}{{}} ORDER BY doc_id) - 1 AS _pos"
_REPRESENTATIVE = "ORDER BY dt_pub ASC NULLS LAST, scraped_at ASC NULLS LAST, length(title) DESC, doc_id"

# Pages: entities of the article, and a paragraph's text as its trimmed runs.
_PLAIN = "replace(replace(replace(replace(replace({}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#x27;', ''''), '&amp;', '&')"
_RUNS = r"array_to_string(list_transform(regexp_split_to_array({}, '<[^>]*>'), lambda r: trim(r, ' ' || chr(10) || chr(9))), '')"


def landed_sql() -> dict[str, str]:
    keyed = f"{_ARTICLES}, {_CANONICAL}"
    sql = {}
    sql["landed_feed_files"] = _sql(
        _ARTICLES, f"SELECT doc_id, title, url, published, dt, {_PLACE.format('')} FROM articles WHERE doc_id % 7 <> 0"
    )
    sql["landed_json_lines"] = _sql(_ARTICLES, "SELECT doc_id, title, summary, url, source, published FROM articles")
    sql["landed_wrapped_files"] = _sql(_ARTICLES, f"SELECT doc_id, title, source, scraped_at, {_PLACE.format(', doc_id % 2')} FROM articles")
    kept = f"{keyed}, kept AS (SELECT * FROM keyed {_FIRST.format('dt, record_key', 'doc_id')})"
    again = f"(dt <> DATE '{DAY}' OR doc_id % 2 = 0)"
    sql["landed_processed_day"] = _sql(
        kept, f"SELECT doc_id, {_normal('title')} AS title, can AS url, source, record_key, dt FROM kept WHERE dt = DATE '{DAY}' AND doc_id % 2 = 0"
    )
    sql["landed_processed_other_days"] = _sql(
        kept, f"SELECT dt, count(*) AS articles, count(DISTINCT record_key) AS keys FROM kept WHERE {again} GROUP BY dt"
    )
    sql["landed_adapted"] = _sql(
        _LABELS,
        f"""SELECT event_id, CASE WHEN is_label THEN s ELSE '' END AS published,
  CASE WHEN is_label THEN coalesce(strftime(t, {_SECOND}) || '+03:00', '') ELSE '' END AS published_iso,
  's' || (event_id % 3) AS source, CAST(now AS DATE) AS dt FROM strict""",
    )
    sql["landed_raw"] = _sql(_ARTICLES, "SELECT doc_id, title, summary, published, scraped_at, dt FROM articles")
    sizes = "sizes AS (SELECT cluster, count(*) AS cluster_size FROM articles GROUP BY cluster)"
    sql["landed_clustered_csv"] = _sql(
        f"{_ARTICLES}, {sizes}", "SELECT doc_id, cluster, cluster_size, source, title, summary FROM articles JOIN sizes USING (cluster)"
    )
    sql["landed_cluster_summary_csv"] = _sql(
        _ARTICLES,
        """SELECT cluster, count(*) AS cluster_size, array_to_string(list_sort(list(DISTINCT source) FILTER (WHERE source <> ''))[1:5], ', ') AS sources,
  first(title ORDER BY dt_pub ASC NULLS FIRST, doc_id) FILTER (WHERE title IS NOT NULL) AS example_title FROM articles GROUP BY cluster""",
    )
    sql["landed_clusters_json"] = _sql(
        _ARTICLES,
        """SELECT cluster, count(*) OVER (PARTITION BY cluster) AS size, (row_number() OVER w - 1) // 10000 AS part,
  CAST((row_number() OVER w - 1) % 10000 AS INTEGER) AS pos, source, title, url, published FROM articles
WINDOW w AS (PARTITION BY cluster ORDER BY published NULLS LAST, doc_id)""",
    )
    sql["landed_run_stats"] = _sql(
        f"{_ARTICLES}, {sizes}",
        """SELECT CAST(sum(cluster_size) AS BIGINT) AS articles, count(*) AS clusters, count(*) FILTER (WHERE cluster_size = 1) AS singletons,
  round(count(*) FILTER (WHERE cluster_size = 1) / sum(cluster_size) * 100.0, 6) AS pct_singletons, '0.83' AS threshold FROM sizes""",
    )
    sql["landed_post_csv"] = _sql(
        _ARTICLES,
        f"""SELECT cluster AS cluster_id, count(*) AS size, first(title {_REPRESENTATIVE}) AS repr_title, first(source {_REPRESENTATIVE}) AS repr_source
FROM articles GROUP BY cluster""",
    )
    sql["landed_post_articles_csv"] = _sql(_ARTICLES, "SELECT cluster AS cluster_id, title, url, source, published AS published_dt, scraped_at FROM articles")
    sql["landed_scraped"] = _sql(
        _LABELS,
        f"""SELECT event_id, CASE WHEN is_label THEN s ELSE '' END AS published,
  CASE WHEN is_label THEN coalesce(strftime(t, {_SECOND}) || '+03:00', '') ELSE '' END AS published_iso, CAST(now AS DATE) AS dt FROM strict""",
    )
    sql["landed_daily"] = _sql(
        keyed,
        f"""SELECT doc_id, {_normal('title')} AS title, can AS url, source, record_key, dt, CAST(doc_id % 2 AS INTEGER) AS feed FROM keyed
{_FIRST.format('dt, record_key', 'doc_id % 2, doc_id')}""",
    )
    sql["landed_rss"] = _sql(
        _ARTICLES,
        f"""SELECT title, coalesce(summary, '') AS summary, coalesce(url, '') AS url, published, CASE WHEN doc_id % 3 = 1 THEN {_UTC} ELSE '' END AS published_iso,
  'n12' AS source, '2025-08-24T12:00:00+03:00' AS scraped_at FROM articles""",
    )
    sql["observed_counts"] = _sql(
        keyed,
        """SELECT 'loaded' AS stage, count(*) AS rows, CAST(0 AS BIGINT) AS undated FROM keyed
UNION ALL SELECT 'kept', count(*), CAST(0 AS BIGINT) FROM (SELECT DISTINCT dt, record_key FROM keyed)""",
    )
    day = "coalesce(strftime(dt_pub, '%Y-%m-%d'), 'no-date')"
    sections = "('אוכל', 'תרבות', 'חדשות', 'דעה', 'ספורט', 'בעולם')"
    sql["landed_dedup_json"] = _sql(
        _ARTICLES,
        f"""SELECT doc_id, dedup_key, dt FROM (SELECT doc_id, dt, {_clean("title")} || '_' || {day} AS dedup_key FROM articles WHERE title NOT IN {sections})
{_FIRST.format("dedup_key", "doc_id")}""",
    )
    sql["landed_preview_csv"] = _sql(_ARTICLES, "SELECT cluster, source, title FROM articles")
    sql["landed_stopwords"] = "SELECT DISTINCT source AS word FROM documents WHERE source <> ''"
    sql["distinct_sources"] = "SELECT DISTINCT source FROM documents WHERE source <> ''"
    sql["union_of_feeds"] = _sql(
        keyed,
        f"""SELECT doc_id, dt, {_normal("t")} AS title, CAST(feed AS INTEGER) AS feed FROM (
  SELECT *, title AS t, 0 AS feed FROM keyed WHERE doc_id % 2 = 0 UNION ALL SELECT *, 'raw ' || title AS t, 1 AS feed FROM keyed WHERE doc_id % 2 = 1 OR doc_id % 3 = 0)
{_FIRST.format("dt, record_key", "feed, doc_id")}""",
    )
    sql["union_of_payloads"] = _sql(_ARTICLES, "SELECT doc_id, title, source FROM articles UNION ALL SELECT doc_id, title, source FROM articles")
    sql["default_columns"] = "SELECT doc_id, source, '' AS title, CAST(NULL AS VARCHAR) AS url FROM documents"
    sql["pulled_field"] = _sql(_ARTICLES, "SELECT published FROM articles")
    pointed = r"'שָׁלוֹם ' || coalesce(regexp_extract(text, '^[^.\n]*', 0), '') || CASE WHEN doc_id % 2 = 0 THEN ' café' ELSE ' café' END || ' מִלְחָמָה'"
    bare = r"regexp_replace(nfc_normalize(title), '[\x{0591}-\x{05C7}]', '', 'g')"
    sql["niqqud_titles"] = f"SELECT doc_id, {_normal('title')} AS normal, {_norm_min(bare)} AS minimal FROM (SELECT doc_id, {pointed} AS title FROM documents)"
    page = "doc_id // 4000 * 40 + doc_id % 40"
    sql["daily_run"] = f"""SELECT page_id, _pos, {_normal("title")} AS title, url, published_iso, 'c14' AS source, 'c14:' || substr(sha1(url), 1, 12) AS record_key,
  DATE '2025-08-24' AS dt FROM (
  SELECT {page} AS page_id, row_number() OVER (PARTITION BY {page} ORDER BY doc_id) - 1 AS _pos, trim(regexp_extract(text, '^[^.\n]*', 0)) AS title,
    'https://site.example/n/' || doc_id AS url,
    strftime(TIMESTAMP '2025-08-24 15:41:39' - to_minutes(CAST(doc_id AS INTEGER)), {_SECOND}) || '+03:00' AS published_iso FROM documents)"""
    sql["tfidf_stopword_table"] = _sql(_weights(3, STOPWORDS), "SELECT doc_id, term, round(w, 6) AS w FROM weights")
    sql["many_headlines"] = f"""SELECT {page} AS page_id, CAST(row_number() OVER (PARTITION BY {page} ORDER BY doc_id) - 1 AS INTEGER) AS pos,
  trim(regexp_extract(text, '^[^.\\n]*', 0)) AS title, 's' || doc_id AS summary, 'https://site.example/n/' || doc_id AS url,
  'לפני ' || doc_id || ' דקות' AS published,
  strftime(TIMESTAMP '2025-08-24 15:41:39' - to_minutes(CAST(doc_id AS INTEGER)), {_SECOND}) || '+03:00' AS published_iso FROM documents"""
    sql["page_headlines"] = f"""SELECT page_id, 0 AS pos, trim({_PLAIN.format("h")}) AS title, {_PLAIN.format(_RUNS.format("rest"))} AS summary, '' AS url,
  {_PLAIN.format(_RUNS.format("CASE WHEN second LIKE '<b>%' THEN second ELSE split_part(second, '</p>', 1) END"))} AS published FROM (
  SELECT page_id, regexp_extract(html, '<h1>(.*?)</h1>', 1, 's') AS h, regexp_extract(html, '</h1>(.*?)</article>', 1, 's') AS rest,
    regexp_extract(html, '</h1><p>.*?<p>(.*?)</article>', 1, 's') AS second FROM pages)"""
    sql["full_text_frame"] = _sql(
        f"""{_ARTICLES}, frame AS (SELECT doc_id, t, s FROM (SELECT *, {_norm_min("title")} AS t, {_norm_min("summary")} AS s FROM articles)
  WHERE trim(t || ' ' || s) <> '' QUALIFY row_number() OVER (PARTITION BY source, t ORDER BY dt_pub DESC NULLS LAST, doc_id DESC) = 1)""",
        "SELECT doc_id, sha256(trim(t || ' ' || s)) AS text_sha256 FROM frame",
    )
    sql["ranked_in_time"] = _sql(
        _ARTICLES, f"SELECT doc_id, {_UTC} AS utc, row_number() OVER (ORDER BY dt_pub NULLS FIRST, doc_id) AS rank FROM articles"
    )
    return sql
