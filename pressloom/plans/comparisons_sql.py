"""DuckDB SQL for the queries that compare outlets."""

from __future__ import annotations

from pressloom.operators.coverage import PERCENTS
from pressloom.plans.catalog_sql import _ARTICLES, _sql, _tfidf, _weights


def comparisons_sql() -> dict[str, str]:
    sql = {}
    named = f"{_ARTICLES}, named AS (SELECT * REPLACE (coalesce(source, '') AS source), concat_ws(' ', title, summary) AS body FROM articles)"
    sql["outlet_overlap"] = _sql(
        f"""{named}, {_tfidf("named", "cluster, source", "body", 1)},
own AS (SELECT cluster, source, count(*) AS n, sqrt(sum(tf * tf)) AS length FROM counts GROUP BY ALL),
outlets AS (SELECT DISTINCT cluster, source FROM named),
pairs AS (SELECT x.cluster, x.source AS a, y.source AS b FROM outlets x JOIN outlets y ON x.cluster = y.cluster AND x.source < y.source),
met AS (SELECT x.cluster, x.source AS a, y.source AS b, count(*) AS shared, sum(x.tf * y.tf) AS dot
  FROM counts x JOIN counts y ON x.cluster = y.cluster AND x.term = y.term AND x.source < y.source GROUP BY ALL)""",
        """SELECT cluster, a, b, coalesce(p.n, 0) AS words_a, coalesce(q.n, 0) AS words_b, coalesce(shared, 0) AS shared,
  CASE WHEN coalesce(p.n, 0) + coalesce(q.n, 0) = 0 THEN 0 ELSE round(coalesce(shared, 0) / (coalesce(p.n, 0) + coalesce(q.n, 0) - coalesce(shared, 0)), 6) END AS jaccard,
  round(coalesce(coalesce(dot, 0) / (p.length * q.length), 0), 6) AS cosine
FROM pairs LEFT JOIN met USING (cluster, a, b) LEFT JOIN own p ON p.cluster = pairs.cluster AND p.source = a
  LEFT JOIN own q ON q.cluster = pairs.cluster AND q.source = b""".replace("SELECT cluster", "SELECT pairs.cluster"),
    )
    sql["event_volume"] = _sql(
        rf"""{named}, counted AS (SELECT cluster, source, len(regexp_extract_all(lower(body), '[\pL\pN_]{{2,}}')) AS w FROM named),
outlets AS (SELECT cluster, source, count(*) AS articles, CAST(sum(w) AS BIGINT) AS words FROM counted GROUP BY ALL),
events AS (SELECT cluster, CAST(sum(articles) AS BIGINT) AS articles, CAST(sum(words) AS BIGINT) AS words FROM outlets GROUP BY cluster),
total AS (SELECT CAST(sum(articles) AS BIGINT) AS articles, CAST(sum(words) AS BIGINT) AS words FROM events)""",
        """SELECT 'outlet' AS level, o.cluster, source, o.articles, o.words, round(o.articles / e.articles, 6) AS article_share,
  coalesce(round(o.words / nullif(e.words, 0), 6), 0) AS word_share FROM outlets o JOIN events e USING (cluster)
UNION ALL SELECT 'event', cluster, NULL, e.articles, e.words, round(e.articles / t.articles, 6), coalesce(round(e.words / nullif(t.words, 0), 6), 0) FROM events e, total t
UNION ALL SELECT 'all', NULL, NULL, articles, words, 1, CASE WHEN words > 0 THEN 1 ELSE 0 END FROM total""",
    )
    sql["first_publisher_lag"] = _sql(
        f"{named}, firsts AS (SELECT cluster, source, min(dt_pub) AS t FROM named GROUP BY cluster, source)",
        """SELECT cluster, source, coalesce(strftime(t, '%Y-%m-%dT%H:%M:%S+00:00'), '') AS first_at,
  CASE WHEN t IS NOT NULL THEN CAST(row_number() OVER w AS INTEGER) END AS place,
  date_diff('second', min(t) OVER (PARTITION BY cluster), t) AS lag_first, date_diff('second', lag(t) OVER w, t) AS lag_previous
FROM firsts WINDOW w AS (PARTITION BY cluster ORDER BY t NULLS LAST, source)""",
    )
    reached = ", ".join(f"min(n) FILTER (WHERE place * 100 >= every * {p}) AS p{p}" for p in PERCENTS)
    sql["headline_lengths"] = _sql(
        f"""{named}, placed AS (SELECT source, CAST(length(coalesce(title, '')) AS INTEGER) AS n,
  row_number() OVER (PARTITION BY source ORDER BY length(coalesce(title, ''))) AS place, count(*) OVER (PARTITION BY source) AS every FROM named)""",
        f"SELECT source, count(*) AS articles, min(n) AS shortest, max(n) AS longest, round(sum(n) / count(*), 6) AS mean, {reached} FROM placed GROUP BY source",
    )
    sql["coverage_grid"] = _sql(
        f"""{named}, dated AS (SELECT source, CAST(dt_pub AS DATE) AS day, cluster FROM named),
days AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM dated),
outlets AS (SELECT DISTINCT source FROM dated),
cells AS (SELECT source, day, count(cluster) AS articles, count(DISTINCT cluster) AS events FROM outlets CROSS JOIN days LEFT JOIN dated USING (source, day) GROUP BY source, day),
totals AS (SELECT day, count(cluster) AS articles, count(DISTINCT cluster) AS events FROM days LEFT JOIN dated USING (day) GROUP BY day),
both_levels AS (SELECT 'cell' AS level, source, day, articles, events FROM cells UNION ALL SELECT 'day', NULL, day, articles, events FROM totals),
running AS (SELECT *, CAST(sum(articles) OVER (PARTITION BY level, source ORDER BY day) AS BIGINT) AS running_articles FROM both_levels)""",
        """SELECT level, source, day, articles, events, running_articles,
  round(running_articles / max(running_articles) FILTER (WHERE level = 'day') OVER (PARTITION BY day), 6) AS running_share FROM running
UNION ALL SELECT 'cell', source, NULL, count(*), count(DISTINCT cluster), NULL, NULL FROM dated WHERE day IS NULL GROUP BY source
UNION ALL SELECT 'day', NULL, NULL, count(*), count(DISTINCT cluster), NULL, NULL FROM dated WHERE day IS NULL HAVING count(*) > 0
UNION ALL SELECT 'outlet', source, NULL, count(*), count(DISTINCT cluster), NULL, NULL FROM dated GROUP BY source
UNION ALL SELECT 'all', NULL, NULL, count(*), count(DISTINCT cluster), NULL, NULL FROM dated""",
    )
    grams = f"""{_weights()},
pieces AS (SELECT doc_id, regexp_replace(lower(title_norm_min), '\\s\\s+', ' ', 'g') AS t FROM frame),
grams AS ({" UNION ALL ".join(f"SELECT doc_id, unnest(list_transform(range(1, length(t) - {n} + 2), lambda i: substr(t, i, {n}))) AS term FROM pieces" for n in (3, 4, 5))}),
gram_counts AS (SELECT doc_id, term, count(*) AS tf FROM grams GROUP BY ALL),
gram_vocab AS (SELECT term, ln((1.0 + n) / (1.0 + df)) + 1.0 AS idf
  FROM (SELECT term, count(*) AS df FROM gram_counts GROUP BY term), (SELECT count(*) AS n FROM frame) WHERE df >= 2 AND df <= 0.8 * n),
gram_weights AS (SELECT doc_id, term, x / sqrt(sum(x * x) OVER (PARTITION BY doc_id)) AS w
  FROM (SELECT doc_id, term, tf * idf AS x FROM gram_counts JOIN gram_vocab USING (term)))"""
    sql["char_tfidf_weights"] = _sql(grams, "SELECT doc_id, term, round(w, 6) AS w FROM gram_weights")
    sql["stacked_cosine_pairs"] = _sql(
        f"""{grams},
beside AS (SELECT doc_id, 'w' || term AS term, w FROM weights UNION ALL SELECT doc_id, 'c' || term, 0.5 * w FROM gram_weights),
stacked AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS w FROM beside),
texts AS (SELECT min(doc_id) AS doc_id, count(*) AS copies FROM frame GROUP BY title_norm_min),
lead AS (SELECT stacked.*, copies FROM stacked JOIN texts USING (doc_id))""",
        """SELECT a.doc_id AS a, b.doc_id AS b, round(sum(a.w * b.w), 6) AS sim, any_value(a.copies) AS copies_a, any_value(b.copies) AS copies_b
FROM lead a JOIN lead b ON a.term = b.term AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id HAVING round(1 - sum(a.w * b.w), 12) < 0.83""",
    )
    return sql
