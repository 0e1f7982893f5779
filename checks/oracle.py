"""DuckDB statements that state each registered query a second time, in SQL.

They share a chain of common table expressions: the feed derived from ``events``, its
term hits by literal search, and the two tables built from them.
"""

from pulse.functions.terms import (
    BLOCKED_TERMS, CATEGORIES, MIN_TERM_LENGTH, SUBSTRING_NEEDLES,
)

# Reports that are registered a second time, from sums per run.
SUM_REPORTS = [
    "overview_kpis", "tool_rankings", "active_authors", "score_box", "recent_runs", "rolling_trend",
]
COMMON_WORDS = {"Common Words": ["the", "and", "des", "que", "und", "of the", "is a"]}


def _text(value):
    return "'" + value.replace("'", "''") + "'"


def _needles(categories, substring, name="needles"):
    """Literal search strings: five per delimited term, the listed ones otherwise."""
    rows, order = [], 0
    for category, terms in categories.items():
        for term in terms:
            order += 1
            if term in BLOCKED_TERMS or len(term) < MIN_TERM_LENGTH:
                continue
            rows.append(f"({order}, {_text(category)}, {_text(term)}, {term not in substring})")
    listed = [
        f"({_text(term)}, {_text(needle)})"
        for term, found in substring.items() for needle in found
    ] or ["(NULL, NULL)"]
    return f"""{name} AS (
  SELECT ord, category, term, e.l || term || e.r AS needle
  FROM (VALUES {', '.join(rows)}) t(ord, category, term, edged),
       (VALUES (' ', ' '), (' ', ','), (' ', '.'), (' ', ':'), ('(', ')')) e(l, r)
  WHERE edged
  UNION ALL
  SELECT ord, category, term, n.needle
  FROM (VALUES {', '.join(rows)}) t(ord, category, term, edged)
  JOIN (VALUES {', '.join(listed)}) n(term, needle) USING (term)
)"""


_LISTED = ", ".join(_text(t) for terms in CATEGORIES.values() for t in terms)
_N_LISTED = sum(len(terms) for terms in CATEGORIES.values())

FEED = f"""
feed AS (
  SELECT event_id, user_id, event_type, run_id, t_epoch,
    CAST(FLOOR((t_epoch % 43200) / 180) AS INTEGER) AS rank,
    CASE event_id % 79 % 9
      WHEN 0 THEN 'Show: ' || t || ' in production'
      WHEN 1 THEN 'Why we left ' || t || ', again'
      WHEN 2 THEN 'Notes (' || t || ')'
      WHEN 3 THEN t || ': a retrospective'
      WHEN 4 THEN 'We moved to ' || t || '.'
      WHEN 5 THEN 'x' || t || 'y internals'
      WHEN 6 THEN upper(t) || ' and ' || t || ' or ' || u
      WHEN 7 THEN 'Is it ' || t || '?'
      ELSE 'sklearn, Power BI and torchlight' END AS title,
    CASE WHEN event_id % 11 = 0 THEN ''
      ELSE 'https://example.org/item/' || event_id END AS url,
    CAST(FLOOR(value) AS INTEGER) AS score,
    CAST(json_extract_string(props, '$.k') AS INTEGER) AS num_comments,
    CASE WHEN event_id % 37 = 0 THEN '[deleted]' WHEN event_id % 41 = 0 THEN ''
      WHEN event_id % 43 = 0 THEN NULL ELSE 'user_' || user_id END AS author,
    CASE WHEN event_id % 47 <> 0 THEN t_epoch END AS created_utc,
    CASE WHEN event_id % 53 <> 0 THEN
      replace(run_id[1:10], '/', '-') || 'T' || replace(run_id[12:16], '-', ':')
      || ':00+00:00' END AS fetched_at,
    CASE WHEN event_type IN ('view', 'click', 'signup') THEN 'top' ELSE 'best' END AS source
  FROM (
    SELECT *, CAST(FLOOR(epoch(ts)) AS BIGINT) AS t_epoch,
      strftime(ts, '%Y/%m/%d') ||
        CASE WHEN event_id % 2 = 0 THEN '/09-00' ELSE '/18-00' END AS run_id,
      list_extract([{_LISTED}], CAST(event_id % {_N_LISTED} AS INTEGER) + 1) AS t,
      list_extract([{_LISTED}], CAST((event_id * 7 + 3) % {_N_LISTED} AS INTEGER) + 1) AS u
    FROM events)
)"""

HITS = """
hits AS (
  SELECT DISTINCT f.event_id, n.ord, n.term, n.category
  FROM feed f JOIN needles n ON contains(' ' || lower(f.title) || ' ', n.needle)
),
tagged AS (
  SELECT event_id, COUNT(*) AS n,
    '{' || string_agg('"' || term || '":"' || category || '"', ',' ORDER BY ord) || '}' AS js
  FROM hits GROUP BY event_id
)"""

RAW = """
raw AS (
  SELECT f.*, CAST(event_id AS VARCHAR) AS post_id,
    CASE WHEN event_id % 59 = 0 THEN '{bad' ELSE coalesce(js, '{}') END AS tool_mentions,
    CAST(coalesce(n, 0) AS INTEGER) AS mention_count
  FROM feed f LEFT JOIN tagged USING (event_id)
)"""

CLEAN = """
clean AS (
  SELECT post_id, event_id, source, title[1:300] AS title, url[1:500] AS url, score,
    num_comments, round(score * 0.6::DOUBLE + num_comments * 0.4::DOUBLE, 2) AS engagement_score,
    author, strftime(make_timestamp(created_utc * 1000000), '%Y-%m-%d') AS created_date,
    CAST(hour(make_timestamp(created_utc * 1000000)) AS INTEGER) AS created_hour,
    dayname(make_timestamp(created_utc * 1000000)) AS created_weekday, fetched_at,
    CASE WHEN tool_mentions = '{bad' THEN '{}' ELSE tool_mentions END AS tool_mentions,
    CASE WHEN tool_mentions = '{bad' THEN 0 ELSE mention_count END AS mention_count
  FROM raw WHERE author IS NOT NULL AND author NOT IN ('[deleted]', '[removed]', '')
)"""

POSTS = """
posts AS (
  SELECT post_id, source, title, url, score, num_comments, engagement_score, author,
    coalesce(created_date, 'None') AS created_date, coalesce(created_hour, 0) AS created_hour,
    coalesce(created_weekday, '') AS created_weekday,
    coalesce(fetched_at, 'None') AS fetched_at, tool_mentions, mention_count
  FROM clean
)"""

MENTIONS = """
mentions AS (
  SELECT c.post_id, h.term AS tool, h.category, c.source, c.score,
    coalesce(c.fetched_at, 'None') AS fetched_at
  FROM clean c JOIN hits h USING (event_id) WHERE c.tool_mentions <> '{}'
)"""

LISTS = """
landed AS (
  SELECT *, 'top' AS list, rank AS place FROM feed
  WHERE event_type IN ('view', 'click', 'signup', 'error')
  UNION ALL
  SELECT *, 'best' AS list, rank + 7 AS place FROM feed
  WHERE event_type IN ('purchase', 'signup', 'error')
),
items AS (
  SELECT run_id, list AS source, CAST(place AS INTEGER) AS rank, event_id,
    event_id AS id, CASE WHEN event_id % 13 = 0 THEN 'job' ELSE 'story' END AS type,
    CASE WHEN event_id % 17 <> 0 THEN title END AS title, url,
    CASE WHEN event_id % 19 <> 0 THEN score END AS score,
    CASE WHEN event_id % 23 <> 0 THEN num_comments END AS descendants,
    author AS "by", created_utc AS "time"
  FROM landed WHERE event_id % 29 <> 0
)"""

RAW_COLUMNS = (
    "post_id, source, title, url, score, num_comments, author, created_utc, fetched_at, "
    "tool_mentions, mention_count"
)
POSTS_COLUMNS = (
    "post_id, source, title, url, score, num_comments, engagement_score, author, "
    "created_date, created_hour, created_weekday, fetched_at, tool_mentions, mention_count"
)

_PARTS = {
    "needles": _needles(CATEGORIES, SUBSTRING_NEEDLES),
    "feed": FEED, "hits": HITS, "raw": RAW, "clean": CLEAN, "posts": POSTS,
    "mentions": MENTIONS, "lists": LISTS,
}


def _with(parts, body):
    return "WITH " + ",\n".join(_PARTS[p].strip() for p in parts.split()) + "\n" + body


def _feed(body):
    return _with("feed", body)


def _raw(body):
    return _with("needles feed hits raw", body)


def _posts(body):
    return _with("needles feed hits raw clean posts", body)


def _mentions(body):
    return _with("needles feed hits raw clean mentions", body)


def _both(body):
    return _with("needles feed hits raw clean posts mentions", body)


def _items(body):
    return _with("feed lists", body)


_STORY = (
    "source, title, score, num_comments, engagement_score, mention_count, url, author, "
    "created_date"
)
_BY_ENGAGEMENT = "ORDER BY engagement_score DESC, post_id, fetched_at"

_COPIES = f"""
, copies AS (SELECT * REPLACE (CAST(user_id AS VARCHAR) AS post_id) FROM raw)
"""
_COPY_ORDER = ", ".join(
    f"{c} NULLS FIRST" for c in RAW_COLUMNS.split(", ") if c not in ("post_id",)
)

# Windows of 7 days that start every half day and hold a mention.
_WINDOWS = """
, timed AS (
  SELECT tool, category, epoch(CAST(fetched_at[1:19] AS TIMESTAMP)) AS sec
  FROM mentions WHERE fetched_at <> 'None'
),
spread AS (
  SELECT CAST((FLOOR(sec / 43200) - k) * 43200 AS BIGINT) AS window_start, tool, category, sec
  FROM timed, range(14) r(k)
),
trend AS (
  SELECT window_start, window_start + 604800 AS window_end, tool, category,
    COUNT(*) AS mentions
  FROM spread GROUP BY window_start, tool, category
)
"""


def statements():
    drill = "Data Engineering"
    sql = {}

    # Ingest
    sql["rank_limit"] = _items(
        "SELECT list AS source, run_id, CAST(place AS INTEGER) AS rank, COUNT(*) AS items "
        "FROM landed WHERE place < 100 GROUP BY ALL"
    )
    sql["valid_stories"] = _items(
        'SELECT run_id, source, rank, id, type, title, url, score, descendants, "by", "time" '
        "FROM items WHERE type = 'story' AND title <> ''"
    )
    sql["union_sources"] = _items(
        "SELECT list AS source, COUNT(*) AS items, COUNT(DISTINCT run_id) AS runs "
        "FROM landed GROUP BY list"
    )
    sql["normalize_items"] = _with("needles feed hits lists", """
, kept AS (
  SELECT * FROM items WHERE rank < 100 AND type = 'story' AND title <> ''
  QUALIFY row_number() OVER (PARTITION BY run_id, id
    ORDER BY CASE source WHEN 'top' THEN 1 ELSE 2 END, rank) = 1
)
SELECT run_id, CAST(id AS VARCHAR) AS post_id, source, title, url,
  coalesce(score, 0) AS score, coalesce(descendants, 0) AS num_comments,
  coalesce("by", '') AS author, coalesce("time", 0) AS created_utc,
  replace(run_id[1:10], '/', '-') || 'T' || replace(run_id[12:16], '-', ':')
    || ':00+00:00' AS fetched_at,
  coalesce(js, '{}') AS tool_mentions, CAST(coalesce(n, 0) AS INTEGER) AS mention_count
FROM kept LEFT JOIN tagged USING (event_id)""")
    sql["extract_mentions"] = _with("needles feed hits", """
SELECT CAST(event_id AS VARCHAR) AS post_id, term AS tool, category FROM hits""")
    sql["mention_count"] = _raw("SELECT post_id, title, mention_count FROM raw")
    sql["dedup_first"] = _raw(f"""{_COPIES}
SELECT run_id, rank, {RAW_COLUMNS} FROM copies
QUALIFY row_number() OVER (PARTITION BY run_id, post_id
  ORDER BY CASE source WHEN 'top' THEN 1 ELSE 2 END, rank, {_COPY_ORDER}) = 1""")
    sql["dedup_latest"] = _raw(f"""{_COPIES}
SELECT run_id, {RAW_COLUMNS} FROM copies
QUALIFY row_number() OVER (PARTITION BY post_id
  ORDER BY fetched_at DESC NULLS LAST, CASE source WHEN 'top' THEN 1 ELSE 2 END,
  {_COPY_ORDER}, run_id) = 1""")
    sql["document_mentions"] = "WITH " + _needles(
        {**CATEGORIES, **COMMON_WORDS}, SUBSTRING_NEEDLES
    ) + """
SELECT DISTINCT d.doc_id, n.term AS tool, n.category
FROM documents d JOIN needles n ON contains(' ' || lower(d.text) || ' ', n.needle)"""

    # Lake
    snapshot_rows = f"SELECT run_id, {RAW_COLUMNS} FROM raw"
    sql["scan_snapshots"] = _raw(snapshot_rows)
    sql["scan_recent_snapshots"] = _raw(snapshot_rows + " WHERE run_id >= '2024/01/16'")
    sql["write_snapshot"] = _raw(f"SELECT '2024/02/01/09-00' AS run_id, {RAW_COLUMNS} FROM raw")
    sql["scan_recent_bronze"] = _raw(snapshot_rows + " WHERE run_id >= '2024/01/16'")
    sql["incremental_ingest"] = _raw(snapshot_rows)
    sql["rewritten_ingest"] = _raw(
        f"SELECT '2024/02/01/09-00' AS run_id, {RAW_COLUMNS} FROM raw WHERE run_id >= '2024/01/16'"
    )
    sql["run_count"] = _feed("SELECT COUNT(DISTINCT run_id) AS runs FROM feed")

    # Cleaning
    sql["clean_authors"] = _feed("""
SELECT CAST(event_id AS VARCHAR) AS post_id, author FROM feed
WHERE author IS NOT NULL AND author NOT IN ('[deleted]', '[removed]', '')""")
    sql["created_parts"] = _feed("""
SELECT CAST(event_id AS VARCHAR) AS post_id, created_utc,
  strftime(make_timestamp(created_utc * 1000000), '%Y-%m-%d') AS created_date,
  CAST(hour(make_timestamp(created_utc * 1000000)) AS INTEGER) AS created_hour,
  dayname(make_timestamp(created_utc * 1000000)) AS created_weekday FROM feed""")
    sql["fill_counts"] = _items("""
SELECT CAST(id AS VARCHAR) AS post_id, source, coalesce(score, 0) AS score,
  coalesce(descendants, 0) AS num_comments FROM items""")
    sql["engagement_score"] = _feed("""
SELECT CAST(event_id AS VARCHAR) AS post_id,
  round(score * 0.6::DOUBLE + num_comments * 0.4::DOUBLE, 2) AS engagement_score FROM feed""")
    sql["parse_mentions"] = _raw("""
SELECT post_id, CASE WHEN tool_mentions = '{bad' THEN '{}' ELSE tool_mentions END
  AS tool_mentions,
  CASE WHEN tool_mentions = '{bad' THEN 0 ELSE mention_count END AS mention_count FROM raw""")
    sql["truncate_text"] = """
SELECT doc_id, substring(text, 1, 300) AS title, substring(text, 1, 500) AS url,
  CAST(length(text) AS INTEGER) AS n_chars FROM documents"""
    sql["load_posts"] = _posts(f"SELECT {POSTS_COLUMNS} FROM posts")
    sql["load_posts_nulls"] = _with(
        "needles feed hits raw clean", f"SELECT {POSTS_COLUMNS} FROM clean"
    )
    sql["load_mentions"] = _mentions(
        "SELECT post_id, tool, category, source, score, fetched_at FROM mentions"
    )
    sql["refresh_days_posts"], sql["refresh_days_mentions"] = sql["load_posts"], sql["load_mentions"]
    sql["loaded_counts"] = _both(
        "SELECT (SELECT COUNT(*) FROM posts) AS posts, (SELECT COUNT(*) FROM mentions) AS mentions"
    )

    # Overview
    sql["overview_kpis"] = _posts("""
SELECT COUNT(*) AS total_posts, COUNT(DISTINCT source) AS sources,
  COUNT(DISTINCT author) AS unique_authors, round(avg(score), 0) AS avg_score,
  CAST(SUM(mention_count) AS BIGINT) AS total_tool_mentions, MAX(fetched_at) AS last_fetch
FROM posts""")
    sql["kpis_display"] = _posts("""
SELECT COUNT(*) AS total_posts, COUNT(DISTINCT source) AS sources,
  COUNT(DISTINCT author) AS unique_authors, CAST(round(avg(score), 0) AS BIGINT) AS avg_score,
  CAST(SUM(mention_count) AS BIGINT) AS total_tool_mentions, MAX(fetched_at) AS last_fetch
FROM posts""")
    sql["top_tools"] = _mentions("""
SELECT tool, category, COUNT(*) AS mentions, round(avg(score), 0) AS avg_post_score
FROM mentions GROUP BY ALL ORDER BY mentions DESC, tool LIMIT 15""")
    sql["source_activity"] = _posts("""
SELECT source, COUNT(*) AS post_count, round(avg(score), 0) AS avg_score,
  CAST(SUM(mention_count) AS BIGINT) AS tool_mentions FROM posts GROUP BY source""")
    sql["top_posts_with_mentions"] = _posts(f"""
SELECT source, title, score, num_comments, engagement_score, mention_count, url
FROM posts WHERE mention_count > 0 {_BY_ENGAGEMENT} LIMIT 10""")

    # Tools
    ranking = """
SELECT tool, category, COUNT(*) AS mentions, COUNT(DISTINCT source) AS sources,
  round(avg(score), 0) AS avg_post_score FROM mentions GROUP BY ALL"""
    sql["tool_rankings"] = _mentions(ranking)
    sql["top20_tools"] = _mentions(ranking + " ORDER BY mentions DESC, tool LIMIT 20")
    sql["tool_source_counts"] = _mentions(
        "SELECT tool, source, COUNT(*) AS mentions FROM mentions GROUP BY ALL"
    )
    sql["tool_source_pivot"] = _mentions("""
SELECT tool, COUNT(*) FILTER (source = 'best') AS best, COUNT(*) FILTER (source = 'top') AS top
FROM mentions GROUP BY tool""")

    # Categories
    sql["category_summary"] = _mentions("""
SELECT category, COUNT(*) AS total_mentions, COUNT(DISTINCT tool) AS unique_tools,
  round(avg(score), 0) AS avg_post_score FROM mentions GROUP BY category""")
    sql["category_share"] = _mentions("""
SELECT category, COUNT(*) AS total_mentions,
  CAST(COUNT(*) AS DOUBLE) / CAST(SUM(COUNT(*)) OVER () AS DOUBLE) AS share
FROM mentions GROUP BY category""")
    sql["category_list"] = _mentions("SELECT DISTINCT category FROM mentions")
    sql["category_drilldown"] = _mentions(f"""
SELECT tool, COUNT(*) AS mentions, round(avg(score), 0) AS avg_score
FROM mentions WHERE category = {_text(drill)} GROUP BY tool""")

    # Stories
    sql["top_stories"] = _posts(f"SELECT {_STORY} FROM posts {_BY_ENGAGEMENT} LIMIT 50")
    sql["top_stories_by_source"] = _posts(
        f"SELECT {_STORY} FROM posts WHERE source = 'best' {_BY_ENGAGEMENT} LIMIT 50"
    )
    sql["stories_table"] = _posts(f"""
SELECT source, title, score, num_comments, mention_count, author
FROM posts {_BY_ENGAGEMENT} LIMIT 50""")
    sql["score_histogram"] = _posts(f"""
, shown AS (SELECT score FROM posts {_BY_ENGAGEMENT} LIMIT 50),
bounds AS (SELECT *, MIN(score) OVER () AS low,
  CAST(MAX(score) OVER () - MIN(score) OVER () AS DOUBLE) / 20 AS width FROM shown),
binned AS (SELECT low, width, CASE WHEN width = 0 THEN 0
  ELSE least(CAST(floor((score - low) / width) AS INTEGER), 19) END AS bin FROM bounds)
SELECT bin, low + bin * width AS bin_start, low + (bin + 1) * width AS bin_end,
  COUNT(*) AS posts FROM binned GROUP BY bin, low, width""")
    for key, term in (("posts_mentioning", "spark"), ("posts_mentioning_r", "r")):
        sql[key] = _posts(f"""
SELECT title, tool_mentions FROM posts WHERE tool_mentions LIKE '%"{term}":%'
ORDER BY post_id, fetched_at LIMIT 10""")

    # Activity
    sql["hourly_activity"] = _posts("""
SELECT created_hour, COUNT(*) AS posts, round(avg(score), 0) AS avg_score
FROM posts GROUP BY created_hour""")
    sql["weekday_activity"] = _posts("""
SELECT created_weekday, COUNT(*) AS posts, round(avg(score), 0) AS avg_score
FROM posts WHERE created_weekday <> '' GROUP BY created_weekday""")
    sql["weekday_ordered"] = _posts("""
SELECT created_weekday, CAST(list_position(['Monday', 'Tuesday', 'Wednesday', 'Thursday',
  'Friday', 'Saturday', 'Sunday'], created_weekday) AS INTEGER) AS weekday_ordinal,
  COUNT(*) AS posts, round(avg(score), 0) AS avg_score
FROM posts WHERE created_weekday <> '' GROUP BY created_weekday""")
    sql["positive_scores"] = _posts("SELECT source, score FROM posts WHERE score > 0")
    sql["score_box"] = _posts("""
, box AS (SELECT source, score, quantile_cont(score, 0.25) OVER w AS q1,
    quantile_cont(score, 0.5) OVER w AS median, quantile_cont(score, 0.75) OVER w AS q3
  FROM posts WHERE score > 0 WINDOW w AS (PARTITION BY source))
SELECT source, q1, median, q3, COUNT(*) AS posts, MIN(score) AS min_score,
  MAX(score) AS max_score,
  MIN(score) FILTER (score >= q1 - 1.5::DOUBLE * (q3 - q1)) AS lower_fence,
  MAX(score) FILTER (score <= q3 + 1.5::DOUBLE * (q3 - q1)) AS upper_fence
FROM box GROUP BY source, q1, median, q3""")
    sql["active_authors"] = _posts("""
SELECT author, COUNT(*) AS posts, round(avg(score), 0) AS avg_score,
  CAST(SUM(num_comments) AS BIGINT) AS total_comments
FROM posts WHERE author NOT IN ('', 'None') GROUP BY author HAVING COUNT(*) > 1
ORDER BY avg_score DESC, author LIMIT 15""")

    # Status
    sql["status_totals"] = _both("""
SELECT (SELECT COUNT(*) FROM posts) AS total_posts,
  (SELECT COUNT(*) FROM mentions) AS total_mentions,
  (SELECT COUNT(DISTINCT fetched_at) FROM posts) AS total_runs""")
    sql["recent_runs"] = _posts("""
SELECT fetched_at, COUNT(*) AS posts, CAST(SUM(mention_count) AS BIGINT) AS tool_mentions
FROM posts GROUP BY fetched_at ORDER BY fetched_at DESC LIMIT 10""")

    # Moving trend
    sql["rolling_trend"] = _mentions(_WINDOWS + "SELECT * FROM trend")
    sql["rolling_trend_stream"] = _mentions(
        _WINDOWS + "SELECT * FROM trend WHERE window_end <= (SELECT MAX(sec) FROM timed) - 86400"
    )
    # The same reports from sums
    sql.update({f"sums_{name}": sql[name] for name in SUM_REPORTS})
    return sql
