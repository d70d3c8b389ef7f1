"""The catalog's queries in DuckDB SQL over the same tables, written independently of the Spark expressions."""

from __future__ import annotations

from pressloom.plans.catalog import AS_OF, QUERY_STOPWORDS, WELCOME

_ARTICLES = r"""
base AS (
  SELECT doc_id, text, source,
    TIMESTAMP '2025-08-10 00:00:00' + to_minutes(CAST(doc_id * 7 % 20000 AS INTEGER)) AS moment,
    CAST(doc_id % 60 AS VARCHAR) AS slot
  FROM documents
),
articles AS (
  SELECT doc_id, regexp_extract(text, '^[^.\n]*', 0) AS title, text AS summary, source,
    CASE WHEN doc_id % 5 = 4 THEN NULL
         WHEN doc_id % 3 = 0 THEN 'HTTP://WWW.C14.co.il/article/' || slot || '/?utm=' || doc_id
         WHEN doc_id % 3 = 1 THEN 'https://www.mako.co.il/news/Article-' || slot || 'x.htm?p=1#f'
         ELSE 'http://Ex.com/p/' || slot || '//?q=1' END AS url,
    CASE WHEN doc_id % 11 = 0 THEN NULL ELSE moment END AS dt_pub,
    CASE WHEN doc_id % 11 = 0 THEN NULL
         WHEN doc_id % 3 = 1 THEN strftime(moment, '%a, %d %b %Y %H:%M:%S +0000')
         ELSE strftime(moment, '%Y-%m-%dT%H:%M:%S+00:00') END AS published,
    strftime(moment + INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%S+00:00') AS scraped_at,
    CAST(moment + INTERVAL 1 HOUR AS DATE) AS dt,
    CASE WHEN doc_id % 10 = 3 THEN doc_id + 1000 ELSE doc_id % 97 END AS cluster
  FROM base
)"""

_CANONICAL = r"""
canonical AS (
  SELECT *, CASE WHEN url IS NULL THEN 'https://' ELSE
      'https://' || host || path || CASE WHEN host LIKE '%mako.co.il%' OR host LIKE '%c14.co.il%' THEN '' ELSE tail END
    END AS can
  FROM (
    SELECT *, lower(regexp_extract(url, '^[A-Za-z]+://([^/?#]*)', 1)) AS host,
      regexp_replace(regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1), '/+$', '') AS path,
      regexp_extract(url, '^[^?#]*(.*)$', 1) AS tail
    FROM articles)
),
keyed AS (
  SELECT *, source || ':' || coalesce(url_id, substr(sha1(can), 1, 12)) AS record_key
  FROM (
    SELECT *, CASE WHEN can LIKE 'https://%c14.co.il/%' THEN nullif(regexp_extract(can, '/article/([0-9]+)', 1), '')
                   WHEN can LIKE 'https://%mako.co.il/%' THEN nullif(regexp_extract(can, 'Article-([A-Za-z0-9]+)\.htm', 1), '')
              END AS url_id
    FROM canonical)
)"""


def _normal(x: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(nfc_normalize({x}), '\s+', ' ', 'g'), '\.{{3,}}', '…', 'g'))"


def _norm_min(x: str) -> str:
    # The lead labels and site names of pressloom.functions.text, written out for SQL.
    labels = "צפו|וידאו|פרשנות|דעה|חשיפה|מיוחד|תיעוד|ראיון|ריאיון|מדריך|הסבר"
    sites = r"N12|חדשות\s?12|mako|כאן\s?11|Kan\s?11|ערוץ\s?14|ynet|גלובס|וואלה|israelhayom"
    clock = r"(^|[^\pL\pN_])((?:[01]?[0-9]|2[0-3]):[0-5][0-9])($|[^\pL\pN_])"
    x = f"replace({x}, '…', '...')"
    x = rf"regexp_replace({x}, '[•·▪◦●○∙]', ' ', 'g')"
    x = rf"regexp_replace({x}, '^(?:{labels})\s*:?\s+', '', 'i')"
    x = rf"regexp_replace({x}, '\s*[|–—-]\s*(?:{sites})\s*$', '', 'i')"
    # Twice: the character between two neighbouring times can only be taken by one of them.
    for _ in range(2):
        x = rf"regexp_replace({x}, '{clock}', '\1 <TIME> \3', 'g')"
    x = rf"regexp_replace(lower({x}), '[0-9]+(?:[.,][0-9]+)?', ' <NUM> ', 'g')"
    x = rf"regexp_replace({x}, '[\x{{05F3}}\x{{05F4}}]', ' ', 'g')"
    return rf"trim(regexp_replace({x}, '[^0-9A-Za-z\x{{0590}}-\x{{05FF}}<>]+', ' ', 'g'))"


def _clean(x: str) -> str:
    x = rf"regexp_replace(regexp_replace({x}, '\s', ' ', 'g'), '[^\pL\pM\pN ]', '', 'g')"
    return rf"lower(trim(regexp_replace({x}, ' +', ' ', 'g')))"


_DECORATED = """CASE doc_id % 5 WHEN 0 THEN 'צפו: ' || title WHEN 1 THEN title || ' | N12'
  WHEN 2 THEN title || ' - ערוץ 14' WHEN 3 THEN 'ב-12:30 ' || title || ' 1,250' ELSE title END"""

def _frame(base: str = "articles") -> str:
    return f"""
frame AS (
  SELECT doc_id, source, t AS title_norm_min FROM (SELECT *, {_norm_min("title")} AS t FROM {base}) WHERE t <> ''
  QUALIFY row_number() OVER (PARTITION BY source, t ORDER BY dt_pub DESC NULLS LAST, doc_id DESC) = 1
)"""


_FRAME = _frame()


def _tfidf(source: str, key: str, text: str, high: int, stop: tuple[str, ...] = ()) -> str:
    """CTEs tokens, terms and counts over `source`; `key` may be several columns."""
    drop = ", ".join(f"'{w}'" for w in stop) or "''"
    grams = " UNION ALL ".join(
        f"SELECT {key}, unnest(list_transform(range(1, len(toks) - {n} + 2), "
        f"lambda i: array_to_string(toks[i:i + {n} - 1], ' '))) AS term FROM tokens"
        for n in range(1, high + 1)
    )
    return rf"""
tokens AS (
  SELECT {key}, list_filter(regexp_extract_all(lower({text}), '[\pL\pN_]{{2,}}'), lambda w: w NOT IN ({drop})) AS toks
  FROM {source}
),
terms AS ({grams}),
counts AS (SELECT {key}, term, count(*) AS tf FROM terms GROUP BY ALL)"""


def _weights(high: int = 2, stop: tuple[str, ...] = (), base: str = "articles") -> str:
    before = _ARTICLES if base == "articles" else f"{_ARTICLES}, {_CANONICAL}, {base} AS (SELECT * FROM keyed QUALIFY row_number() OVER (PARTITION BY dt, record_key ORDER BY doc_id) = 1)"
    return f"""{before}, {_frame(base)}, {_tfidf("frame", "doc_id", "title_norm_min", high, stop)},
vocab AS (
  SELECT term, ln((1.0 + n) / (1.0 + df)) + 1.0 AS idf
  FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), (SELECT count(*) AS n FROM frame)
  WHERE df >= 2 AND df <= 0.75 * n
),
weights AS (
  SELECT doc_id, term, x / sqrt(sum(x * x) OVER (PARTITION BY doc_id)) AS w
  FROM (SELECT doc_id, term, tf * idf AS x FROM counts JOIN vocab USING (term))
)"""


def _linked(base: str = "articles") -> str:
    """CTEs up to events(doc_id, cluster): average linkage at a cosine distance of 0.83 over the frame of `base`.

    A round is one step of the recursion: its rows are the sums of similarities between clusters (kind 0: a, b, s and both
    sizes) and the members of each cluster (kind 1: a in b, weight na).  All clusters that are each other's nearest merge, and
    the sums of the merged ones add up, since the mean over a merged cluster is the mean over its parts' members.
    """
    return f"""{_weights(base=base)},
texts AS (SELECT title_norm_min, min(doc_id) AS doc_id, count(*) AS copies FROM frame GROUP BY title_norm_min),
signed AS (SELECT doc_id, string_agg(term || chr(1) || tf, chr(2) ORDER BY term) AS signature
  FROM counts JOIN vocab USING (term) JOIN texts USING (doc_id) GROUP BY doc_id),
vectors AS (SELECT signature, min(doc_id) AS v, CAST(sum(copies) AS DOUBLE) AS n FROM signed JOIN texts USING (doc_id) GROUP BY signature),
first_sums AS (SELECT a.doc_id AS a, b.doc_id AS b, sum(a.w * b.w) * any_value(x.n) * any_value(y.n) AS s, any_value(x.n) AS na, any_value(y.n) AS nb
  FROM weights a JOIN vectors x ON x.v = a.doc_id JOIN weights b ON a.term = b.term AND a.doc_id < b.doc_id JOIN vectors y ON y.v = b.doc_id GROUP BY a.doc_id, b.doc_id),
rounds(round, kind, a, b, s, na, nb) AS (
  SELECT 0, 0, a, b, s, na, nb FROM first_sums UNION ALL SELECT 0, 1, v, v, 0.0, n, 0.0 FROM vectors
  UNION ALL
  (WITH near AS (
    SELECT c, min(e) AS e FROM (
      SELECT unnest([a, b]) AS c, {{'d': round(1 - s / (na * nb), 12), 'a': a, 'b': b}} AS e FROM rounds WHERE kind = 0)
    WHERE e.d < 0.83 GROUP BY c),
  moved AS (SELECT e.b AS old, e.a AS new FROM near GROUP BY e HAVING count(*) = 2),
  members AS (SELECT r.a, coalesce(m.new, r.b) AS b, r.na FROM rounds r LEFT JOIN moved m ON r.b = m.old WHERE kind = 1),
  sizes AS (SELECT b AS c, sum(na) AS n FROM members GROUP BY b),
  sums AS (
    SELECT least(x, y) AS a, greatest(x, y) AS b, sum(s) AS s FROM (
      SELECT coalesce(p.new, r.a) AS x, coalesce(q.new, r.b) AS y, r.s
      FROM rounds r LEFT JOIN moved p ON r.a = p.old LEFT JOIN moved q ON r.b = q.old WHERE kind = 0)
    WHERE x <> y GROUP BY ALL),
  now AS (SELECT max(round) + 1 AS round FROM rounds)
  SELECT now.round, 0, sums.a, sums.b, s, i.n, j.n FROM sums JOIN sizes i ON i.c = a JOIN sizes j ON j.c = b, now WHERE EXISTS (FROM moved)
  UNION ALL SELECT now.round, 1, a, b, 0.0, na, 0.0 FROM members, now WHERE EXISTS (FROM moved))),
ends AS (SELECT a AS v, b AS cluster FROM rounds WHERE kind = 1 AND round = (SELECT max(round) FROM rounds)),
events AS (SELECT frame.doc_id, frame.source, coalesce(ends.cluster, frame.doc_id) AS cluster
  FROM frame JOIN texts USING (title_norm_min) LEFT JOIN signed ON signed.doc_id = texts.doc_id LEFT JOIN vectors USING (signature) LEFT JOIN ends USING (v))"""


_LABELS = """
labelled AS (
  SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+03:00' AS scraped_at, ts AS now,
    CASE event_id % 16
      WHEN 0 THEN 'לפני ' || n || ' דקות' WHEN 1 THEN 'לפני ' || n || ' שעות' WHEN 2 THEN 'לפני כשעה'
      WHEN 3 THEN 'לפני שעתיים' WHEN 4 THEN 'לפני יום' WHEN 5 THEN 'לפני ' || n || ' ימים'
      WHEN 6 THEN 'אתמול ' || h || ':' || m WHEN 7 THEN 'אתמול' WHEN 8 THEN ' ' || h || ':' || m || ' '
      WHEN 9 THEN h || '.' || m WHEN 10 THEN n || ' minutes ago' WHEN 11 THEN 'Yesterday at ' || h || ':' || m
      WHEN 12 THEN n || ' hrs ago' WHEN 13 THEN 'כותרת כתבה' WHEN 14 THEN event_type END AS label
  FROM (SELECT *, CAST(event_id % 70 AS VARCHAR) AS n, lpad(CAST(event_id % 26 AS VARCHAR), 2, '0') AS h,
          lpad(CAST(event_id % 63 AS VARCHAR), 2, '0') AS m FROM events)
),
parts AS (
  SELECT *, string_split_regex(s, '\\s+') AS w, date_trunc('day', now) AS midnight,
    CAST(coalesce(nullif(regexp_extract(s, '[0-9]+', 0), ''), '1') AS INTEGER) AS num,
    TRY_CAST(regexp_extract(s, '([0-9]{1,2})[:.]([0-9]{2})', 1) AS INTEGER) AS hh,
    TRY_CAST(regexp_extract(s, '([0-9]{1,2})[:.]([0-9]{2})', 2) AS INTEGER) AS mm,
    regexp_matches(s, '[\\x{0590}-\\x{05FF}]') AS he
  FROM (SELECT *, trim(coalesce(label, '')) AS s FROM labelled)
),
judged AS (
  SELECT *, s <> '' AND (
      regexp_full_match(s, '[0-9]{1,2}[:.][0-9]{2}')
      OR (length(s) <= 10 AND regexp_full_match(s, '[ 0-9:.\\-/]+'))
      OR contains(lower(s), CASE WHEN he THEN 'אתמול' ELSE 'yesterday' END)
      OR (ago AND (has_num OR unit)) OR (has_num AND unit)) AS is_label
  FROM (SELECT *, regexp_matches(s, '[0-9]') AS has_num,
      CASE WHEN he THEN contains(s, 'לפני') ELSE contains(s, 'ago') END AS ago,
      CASE WHEN he THEN regexp_matches(s, 'דקה|דקות|שעה|שעות|כשעה|שעתיים|יום|ימים|יומיים')
           ELSE regexp_matches(s, 'min|hour|hr|day') END AS unit FROM parts)
),
strict AS (
  SELECT *, CASE
      WHEN s LIKE 'לפני %' THEN CASE
        WHEN w[-1] LIKE 'דק%' THEN now - to_minutes(num) WHEN w[-1] LIKE 'שע%' THEN now - to_hours(num)
        WHEN w[-1] LIKE 'כשע%' THEN now - to_hours(1) WHEN w[-1] LIKE 'יום%' THEN now - to_days(num) END
      WHEN s LIKE 'אתמול %' THEN CASE WHEN hh < 24 AND mm < 60
        THEN midnight - to_days(1) + to_hours(hh) + to_minutes(mm) END
      WHEN regexp_full_match(s, '[0-9]{1,2}:[0-9]{1,2}') AND hh < 24 AND mm < 60 THEN
        CASE WHEN midnight + to_hours(hh) + to_minutes(mm) > now
          THEN midnight - to_days(1) + to_hours(hh) + to_minutes(mm) ELSE midnight + to_hours(hh) + to_minutes(mm) END
      END AS t,
    CASE WHEN s = 'לפני שעתיים' THEN now - to_hours(2) WHEN s LIKE 'לפני %ימים' THEN now - to_days(num) END AS t_dual
  FROM judged
),
loose AS (
  SELECT *, CASE
      WHEN s = '' THEN NULL
      WHEN regexp_full_match(s, '[0-9]{1,2}[:.][0-9]{2}') THEN
        CASE WHEN hh < 24 AND mm < 60 THEN midnight + to_hours(hh) + to_minutes(mm) END
      WHEN contains(lower(s), CASE WHEN he THEN 'אתמול' ELSE 'yesterday' END) THEN
        CASE WHEN hh IS NULL THEN now - to_days(1)
             WHEN hh < 24 AND mm < 60 THEN midnight - to_days(1) + to_hours(hh) + to_minutes(mm) END
      WHEN he AND contains(s, 'שעתיים') THEN now - to_hours(2)
      WHEN he AND contains(s, 'יומיים') THEN now - to_days(2)
      WHEN NOT (he OR contains(s, 'ago')) THEN NULL
      WHEN regexp_matches(s, CASE WHEN he THEN 'דקה|דקות' ELSE 'min' END) THEN now - to_minutes(num)
      WHEN regexp_matches(s, CASE WHEN he THEN 'שעה|שעות' ELSE 'hour|hr' END) THEN now - to_hours(num)
      WHEN regexp_matches(s, CASE WHEN he THEN 'יום|ימים' ELSE 'day' END) THEN now - to_days(num)
      END AS t
  FROM parts
)""".replace("\\\\", "\\")

_SECOND = "'%Y-%m-%dT%H:%M:%S'"
_UTC = "coalesce(strftime(dt_pub, '%Y-%m-%dT%H:%M:%S+00:00'), '')"


def _sql(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select.strip()}"


def oracle_sql() -> dict[str, str]:
    keyed = f"{_ARTICLES}, {_CANONICAL}"
    sizes = "sizes AS (SELECT cluster, count(*) AS cluster_size FROM articles GROUP BY cluster)"
    spread = """spread AS (SELECT cluster, count(*) AS cluster_size, count(DISTINCT source) AS n_sources
  FROM articles GROUP BY cluster)"""
    representative = """ORDER BY dt_pub ASC NULLS LAST, scraped_at ASC NULLS LAST, length(title) DESC, doc_id"""
    stats = """count(*) AS clusters, sum(CASE WHEN cluster_size = 1 THEN 1 ELSE 0 END)"""
    sql = {}
    sql["canonical_urls"] = _sql(keyed, "SELECT doc_id, can AS canonical_url FROM canonical")
    sql["url_ids"] = _sql(keyed, "SELECT doc_id, coalesce(host, '') AS host, url_id FROM keyed")
    sql["record_keys"] = _sql(keyed, "SELECT doc_id, record_key, substr(sha1(can), 1, 10) AS url_hash FROM keyed")
    sql["normalized_text"] = _sql(
        _ARTICLES, f"SELECT doc_id, {_normal('title')} AS title, {_normal('summary')} AS summary FROM articles"
    )
    sql["norm_min_titles"] = _sql(
        _ARTICLES,
        f"""SELECT doc_id, {_norm_min("title")} AS title_norm_min, {_norm_min("summary")} AS summary_norm_min
FROM (SELECT doc_id, {_DECORATED} AS title, summary FROM articles)""",
    )
    sql["clean_titles"] = _sql(
        _ARTICLES,
        rf"""SELECT doc_id, {_clean("title")} AS clean_title, trim(regexp_replace(summary, '\s+', ' ', 'g')) AS clean_summary
FROM (SELECT doc_id, {_DECORATED} AS title, summary FROM articles)""",
    )
    day = "coalesce(strftime(dt_pub, '%Y-%m-%d'), 'no-date')"
    sections = "('אוכל', 'תרבות', 'חדשות', 'דעה', 'ספורט', 'בעולם')"
    sql["legacy_keys"] = _sql(
        _ARTICLES,
        f"""SELECT doc_id, {_UTC} AS published_dt, {_clean("title")} || '_' || {day} AS dedup_key
FROM articles WHERE title NOT IN {sections}""",
    )
    sql["time_label_flags"] = _sql(
        _LABELS, "SELECT event_id, CASE WHEN he THEN 'he' ELSE 'en' END AS locale, is_label FROM judged"
    )
    sql["time_label_iso"] = _sql(
        _LABELS,
        f"""SELECT event_id, coalesce(strftime(t, {_SECOND}) || '+03:00', '') AS iso,
  coalesce(strftime(coalesce(t_dual, t), {_SECOND}) || '+03:00', '') AS iso_dual FROM strict""",
    )
    sql["time_label_loose"] = _sql(
        _LABELS,
        f"""SELECT event_id, strftime(t, {_SECOND}) || CASE WHEN microsecond(t) % 1000000 = 0 THEN ''
  ELSE strftime(t, '.%f') END || '+03:00' AS iso FROM loose""",
    )
    sql["published_instants"] = _sql(
        _ARTICLES,
        f"""SELECT doc_id, {_UTC} AS utc, CASE WHEN doc_id % 3 = 1 THEN {_UTC} ELSE '' END AS mail_iso FROM articles""",
    )
    sql["date_range"] = _sql(
        _ARTICLES,
        "SELECT doc_id FROM articles WHERE CAST(dt_pub AS DATE) BETWEEN DATE '2025-08-12' AND DATE '2025-08-19'",
    )
    sql["window_days"] = _sql(
        _ARTICLES, f"SELECT doc_id FROM articles WHERE CAST(dt_pub AS DATE) > CAST('{AS_OF}' AS DATE) - 2"
    )
    sql["window_hours"] = _sql(
        _ARTICLES, f"SELECT doc_id FROM articles WHERE dt_pub > TIMESTAMP '{AS_OF}' - INTERVAL 36 HOUR"
    )
    sql["adapted_records"] = _sql(
        _LABELS,
        f"""SELECT event_id, CASE WHEN is_label THEN s ELSE '' END AS published,
  CASE WHEN is_label THEN coalesce(strftime(t, {_SECOND}) || '+03:00', '') ELSE '' END AS published_iso FROM strict""",
    )
    sql["processed_articles"] = _sql(
        keyed,
        f"""SELECT doc_id, {_normal("title")} AS title, {_normal("summary")} AS summary, can AS url, source,
  {_norm_min("title")} AS title_norm_min, {_norm_min("summary")} AS summary_norm_min, url_id, record_key FROM keyed""",
    )
    sectioned = "CASE doc_id % 9 WHEN 0 THEN 'תרבות' WHEN 1 THEN 'ספורט' ELSE title END"
    sql["category_filter"] = _sql(
        _ARTICLES,
        f"SELECT * FROM (SELECT doc_id, {sectioned} AS title FROM articles) WHERE title NOT IN {sections}",
    )
    sql["suspicious_titles"] = _sql(
        _ARTICLES,
        f"""SELECT doc_id, source, title FROM (
  SELECT doc_id, source, CASE WHEN doc_id % 9 = 0 THEN 'תרבות' ELSE title END AS title FROM articles)
WHERE length(title) <= 6 OR title IN {sections}""",
    )
    sql["boilerplate_filter"] = _sql(
        _ARTICLES,
        f"""SELECT doc_id, source, summary FROM (
  SELECT doc_id, source, CASE WHEN source IN ('src1', 'src2', 'src3') AND (doc_id // 20) % 5 < 3 THEN '{WELCOME}'
    WHEN source = 'src4' THEN '' ELSE summary END AS summary FROM articles)
QUALIFY summary = '' OR NOT (count(*) OVER (PARTITION BY source, summary) >= 5
  AND count(*) OVER (PARTITION BY source, summary) >= 0.5 * count(*) OVER (PARTITION BY source))""",
    )
    sql["top_summaries"] = _sql(
        _ARTICLES,
        """SELECT source, coalesce(summary, '') AS summary, count(*) AS n FROM articles GROUP BY ALL
ORDER BY n DESC, source, summary LIMIT 20""",
    )
    first = "QUALIFY row_number() OVER (PARTITION BY {} ORDER BY doc_id) = 1"
    sql["dedup_record_key"] = _sql(keyed, f"SELECT doc_id, dt, record_key FROM keyed {first.format('dt, record_key')}")
    sql["dedup_record_key_blank_kept"] = _sql(
        keyed,
        f"SELECT doc_id, dt, record_key FROM keyed {first.format('dt, record_key, CASE WHEN url IS NULL THEN doc_id END')}",
    )
    sql["dedup_latest_title"] = _sql(f"{_ARTICLES}, {_FRAME}", "SELECT doc_id, source, title_norm_min FROM frame")
    sql["dedup_key_first"] = _sql(
        _ARTICLES,
        f"""SELECT doc_id, dedup_key FROM (
  SELECT doc_id, CASE WHEN doc_id % 11 <> 0 THEN {_clean("title")} || '_' || {day} END AS dedup_key
  FROM articles WHERE title NOT IN {sections}) {first.format("dedup_key")}""",
    )
    sql["duplicate_urls"] = _sql(
        keyed, "SELECT doc_id, can AS url FROM keyed QUALIFY count(*) OVER (PARTITION BY can) > 1"
    )
    sql["dedup_url_keep_blank"] = _sql(
        _ARTICLES,
        f"""SELECT doc_id, u AS url FROM (SELECT doc_id, regexp_replace(url, '[?#].*$', '') AS u FROM articles)
{first.format("u, CASE WHEN u IS NULL THEN doc_id END")}""",
    )
    sql["stage_counts"] = _sql(
        keyed, "SELECT dt, count(*) AS loaded, count(DISTINCT record_key) AS kept FROM keyed GROUP BY dt"
    )
    sql["tfidf_weights"] = _sql(_weights(), "SELECT doc_id, term, round(w, 6) AS w FROM weights")
    sql["tfidf_without_stopwords"] = _sql(
        _weights(3, QUERY_STOPWORDS), "SELECT doc_id, term, round(w, 6) AS w FROM weights"
    )
    sql["cosine_pairs"] = _sql(
        f"""{_weights()},
texts AS (SELECT min(doc_id) AS doc_id, count(*) AS copies FROM frame GROUP BY title_norm_min),
lead AS (SELECT weights.*, copies FROM weights JOIN texts USING (doc_id))""",
        """SELECT a.doc_id AS a, b.doc_id AS b, round(sum(a.w * b.w), 6) AS sim,
  any_value(a.copies) AS copies_a, any_value(b.copies) AS copies_b
FROM lead a JOIN lead b ON a.term = b.term AND a.doc_id < b.doc_id
GROUP BY a.doc_id, b.doc_id HAVING round(1 - sum(a.w * b.w), 12) < 0.83""",
    )
    sql["event_clusters"] = _sql(f"RECURSIVE {_linked()}", "SELECT doc_id, source, cluster FROM events")
    sql["events_overview"] = _sql(
        f"RECURSIVE {_linked('kept')}",
        f"""SELECT cluster, count(*) AS cluster_size, array_to_string(list_sort(list(DISTINCT source) FILTER (WHERE source <> ''))[1:5], ', ') AS sources,
  first({_normal("title")} ORDER BY dt_pub ASC NULLS FIRST, doc_id) FILTER (WHERE title IS NOT NULL) AS example_title
FROM (SELECT e.cluster, e.source, k.title, k.dt_pub, k.doc_id FROM events e JOIN kept k USING (doc_id)) GROUP BY cluster""",
    )
    sql["cluster_sizes"] = _sql(
        f"{_ARTICLES}, {sizes}", "SELECT doc_id, cluster, cluster_size FROM articles JOIN sizes USING (cluster)"
    )
    sql["cluster_run_stats"] = _sql(
        f"""{_ARTICLES}, {sizes},
s AS (SELECT CAST(sum(cluster_size) AS BIGINT) AS articles, {stats} AS singletons FROM sizes)""",
        """SELECT articles, clusters, CAST(singletons AS BIGINT) AS singletons,
  round(singletons / articles * 100.0, 6) AS pct_singletons, 'articles' AS share_of FROM s
UNION ALL SELECT articles, clusters, CAST(singletons AS BIGINT), round(singletons / clusters * 100.0, 6), 'clusters' FROM s""",
    )
    sql["cluster_summary"] = _sql(
        _ARTICLES,
        """SELECT cluster, count(*) AS cluster_size,
  array_to_string(list_sort(list(DISTINCT source) FILTER (WHERE source <> ''))[1:5], ', ') AS sources,
  first(title ORDER BY dt_pub ASC NULLS FIRST, doc_id) FILTER (WHERE title IS NOT NULL) AS example_title
FROM articles GROUP BY cluster""",
    )
    sql["cluster_items"] = _sql(
        _ARTICLES,
        """SELECT cluster, count(*) OVER (PARTITION BY cluster) AS size,
  row_number() OVER (PARTITION BY cluster ORDER BY published NULLS LAST, doc_id) - 1 AS pos,
  source, title, url, published FROM articles""",
    )
    sql["cluster_items_nested"] = _sql(
        _ARTICLES,
        """SELECT cluster, size, pos // 4 AS part, CAST(pos % 4 AS INTEGER) AS pos, source, title, url, published FROM (
  SELECT *, count(*) OVER (PARTITION BY cluster) AS size,
    row_number() OVER (PARTITION BY cluster ORDER BY published NULLS LAST, doc_id) - 1 AS pos FROM articles)""",
    )
    sql["cluster_representatives"] = _sql(
        _ARTICLES,
        f"""SELECT cluster AS cluster_id, doc_id, title, url, source FROM articles
QUALIFY row_number() OVER (PARTITION BY cluster {representative}) = 1""",
    )
    sql["cluster_timespan"] = _sql(
        _ARTICLES,
        f"""SELECT cluster AS cluster_id, count(*) AS size, first(title {representative}) AS repr_title,
  first(url {representative}) AS repr_url, first(source {representative}) AS repr_source,
  array_to_string(list_sort(list(DISTINCT source)), ', ') AS sources,
  coalesce(strftime(min(dt_pub), '%Y-%m-%dT%H:%M:%S+00:00'), '') AS first_published_dt,
  coalesce(strftime(max(dt_pub), '%Y-%m-%dT%H:%M:%S+00:00'), '') AS last_published_dt
FROM articles GROUP BY cluster""",
    )
    sql["source_spread"] = _sql(f"{_ARTICLES}, {spread}", "SELECT * FROM spread")
    sql["multi_source_share"] = _sql(
        f"{_ARTICLES}, {spread}",
        """SELECT round(avg(CAST(n_sources >= 2 AS INTEGER)) * 100, 6) AS pct_clusters_multi,
  round(sum(CASE WHEN n_sources >= 2 THEN cluster_size ELSE 0 END) / sum(cluster_size) * 100, 6) AS pct_articles_multi
FROM spread""",
    )
    sql["multi_source_articles"] = _sql(
        f"{_ARTICLES}, {spread}",
        "SELECT doc_id, cluster FROM articles WHERE cluster IN (SELECT cluster FROM spread WHERE n_sources >= 2)",
    )
    sql["top_clusters"] = _sql(
        f"{_ARTICLES}, {sizes}", "SELECT * FROM sizes ORDER BY cluster_size DESC, cluster LIMIT 10"
    )
    sql["top_multi_source_clusters"] = _sql(
        f"{_ARTICLES}, {spread}", "SELECT * FROM spread ORDER BY n_sources DESC, cluster_size DESC, cluster LIMIT 10"
    )
    sql["cluster_samples"] = _sql(
        _ARTICLES,
        """SELECT cluster, CAST(row_number() OVER (PARTITION BY cluster ORDER BY doc_id) AS INTEGER) AS sample_rank, doc_id,
  substr(title, 1, 200) AS title FROM articles QUALIFY sample_rank <= 3""",
    )
    sql["articles_by_cluster"] = _sql(
        _ARTICLES,
        "SELECT cluster AS cluster_id, title, summary, url, source, published AS published_dt, scraped_at FROM articles",
    )
    sql["cluster_top_terms"] = _sql(
        rf"""{_ARTICLES},
tokens AS (
  SELECT cluster, doc_id, list_filter(regexp_extract_all(lower(title || ' ' || summary), '[\pL\pN_]{{2,}}'),
    lambda w: regexp_full_match(w, '\pL{{2,}}')) AS toks FROM articles
),
terms AS (
  SELECT cluster, doc_id, unnest(toks) AS term FROM tokens UNION ALL
  SELECT cluster, doc_id, unnest(list_transform(range(1, len(toks)), lambda i: toks[i] || ' ' || toks[i + 1])) FROM tokens
),
counts AS (SELECT cluster, doc_id, term, count(*) AS tf FROM terms GROUP BY ALL),
{sizes},
vocab AS (
  SELECT cluster, term, n, ln((1.0 + n) / (1.0 + df)) + 1.0 AS idf FROM (
    SELECT counts.cluster, term, count(*) AS df, any_value(cluster_size) AS n
    FROM counts JOIN sizes USING (cluster) GROUP BY counts.cluster, term)
  WHERE df <= 0.95 * n
),
scaled AS (
  SELECT cluster, term, n, x / sqrt(sum(x * x) OVER (PARTITION BY cluster, doc_id)) AS w
  FROM (SELECT counts.cluster, doc_id, counts.term, n, tf * idf AS x FROM counts JOIN vocab USING (cluster, term))
),
means AS (SELECT cluster, term, round(sum(w) / max(n), 9) AS weight FROM scaled GROUP BY cluster, term)""",
        """SELECT cluster, CAST(row_number() OVER (PARTITION BY cluster ORDER BY weight DESC, term) AS INTEGER) AS rank, term,
  round(weight, 6) AS weight FROM means QUALIFY rank <= 12""",
    )
    sql["time_ordered"] = _sql(_ARTICLES, f"SELECT doc_id, {_UTC} AS utc FROM articles")
    sql["oldest_articles"] = _sql(
        _ARTICLES,
        f"SELECT doc_id, utc FROM (SELECT doc_id, {_UTC} AS utc, dt_pub FROM articles) ORDER BY dt_pub NULLS FIRST, doc_id LIMIT 137",
    )
    sql["review_articles"] = _sql(
        f"{_ARTICLES}, {sizes}",
        """SELECT cluster, cluster_size, source, published, title, summary, url, doc_id
FROM articles JOIN sizes USING (cluster)""",
    )
    sql["json_array_scan"] = _sql(
        _ARTICLES, "SELECT doc_id, title, summary, url, source, dt, CAST(0 AS BIGINT) AS _pos FROM articles"
    )
    raw = "doc_id, title, coalesce(summary, '') AS summary, coalesce(url, '') AS url, published"
    sql["rss_n12_articles"] = _sql(
        _ARTICLES,
        f"""SELECT {raw}, CASE WHEN doc_id % 3 = 1 THEN {_UTC} ELSE '' END AS published_iso, 'n12' AS source, scraped_at
FROM articles""",
    )
    sql["rss_kan11_articles"] = _sql(
        _ARTICLES,
        f"""SELECT {raw}, CASE WHEN doc_id % 3 = 1 THEN strftime(dt_pub, {_SECOND}) END AS published_iso,
  'kan11' AS source, scraped_at FROM articles""",
    )
    return sql
