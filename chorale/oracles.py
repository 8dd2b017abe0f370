"""The same queries as SQL over the benchmark tables, for a second engine to check against."""

from __future__ import annotations

from chorale.functions.sentiment import NEGATIVE_WORDS, POSITIVE_WORDS
from chorale.functions.text import WATCH_URL_PREFIX
from chorale.operators.retrieval import STOP_WORDS


def _words(ws) -> str:
    return ", ".join(f"'{w}'" for w in ws)


_PROP = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
_ISO = "strftime(ts, '%Y-%m-%dT%H:%M:%SZ')"
_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"

# Each CTE may use the ones it names in _NEEDS.
_CTE = {
    "raw": f"""
        SELECT CAST(i AS VARCHAR) AS comment_id, 'vid' || (i % 20) AS video_id,
               '@ch' || ((i % 20) % 4) AS channel_handle, 'user' || user_id AS author_name,
               CASE WHEN i % 37 = 0 THEN '   ' WHEN i % 11 = 0 THEN '  ' || text || ' ' ELSE text END AS text,
               CAST(floor(value) AS BIGINT) AS like_count, CAST({_PROP} % 6 AS INTEGER) AS reply_count,
               {_ISO} AS published_at, (i // 20) % 3 <> 0 AS is_reply,
               CASE WHEN (i // 20) % 3 <> 0 THEN CAST(i - 20 * ((i // 20) % 3) AS VARCHAR) END AS parent_id,
               'Video #' || (i % 20) || ': intro & tips!' AS video_title,
               '{WATCH_URL_PREFIX}vid' || (i % 20) AS video_url, {_ISO} AS ingested_at,
               i // 20 AS slot, date_trunc('second', ts) AS posted
        FROM (SELECT *, event_id AS i FROM events) e LEFT JOIN documents
             ON doc_id = i % greatest((SELECT COUNT(*) FROM documents), 1)""",
    "silver": """
        SELECT comment_id, video_id, video_title AS title, video_url, channel_handle, author_name,
               trim(text, ' ') AS text, like_count, reply_count, posted AS published_at, is_reply, parent_id
        FROM raw WHERE length(trim(text, ' ')) > 0""",
    "scored": f"""
        SELECT * EXCLUDE (toks), CASE WHEN pos > neg THEN 'positive' WHEN neg > pos THEN 'negative' ELSE 'neutral' END AS sentiment
        FROM (SELECT *, len(list_filter(toks, lambda t: t IN ({_words(POSITIVE_WORDS)}))) AS pos,
                     len(list_filter(toks, lambda t: t IN ({_words(NEGATIVE_WORDS)}))) AS neg
              FROM (SELECT *, string_split_regex(lower(text), '[^a-z'']+') AS toks FROM silver))""",
    "gold": """
        SELECT video_id, channel_handle, title, video_url, COUNT(*) AS total_comments,
               CAST(SUM(like_count) AS BIGINT) AS total_likes,
               CAST(ROUND(CAST(AVG(like_count) AS DECIMAL(18,6)), 2) AS DOUBLE) AS avg_likes_per_comment,
               CAST(SUM(reply_count) AS BIGINT) AS total_replies,
               COUNT(*) FILTER (sentiment = 'positive') AS positive_comments,
               COUNT(*) FILTER (sentiment = 'negative') AS negative_comments,
               COUNT(*) FILTER (sentiment = 'neutral') AS neutral_comments,
               CAST(ROUND(CAST(SUM(CASE sentiment WHEN 'positive' THEN 1 WHEN 'negative' THEN -1 ELSE 0 END)
                    / CAST(COUNT(*) AS DOUBLE) AS DECIMAL(18,9)), 3) AS DOUBLE) AS sentiment_score,
               MAX(published_at) AS latest_comment_at
        FROM scored WHERE NOT is_reply GROUP BY ALL""",
    "kpis": """
        SELECT channel_handle, COUNT(*) AS videos_analyzed, CAST(SUM(total_comments) AS BIGINT) AS total_comments,
               CAST(ROUND(CAST(AVG(sentiment_score) AS DECIMAL(18,9)), 3) AS DOUBLE) AS avg_sentiment,
               CAST(ROUND(CAST(AVG(avg_likes_per_comment) AS DECIMAL(18,9)), 2) AS DOUBLE) AS avg_engagement,
               CAST(SUM(positive_comments) AS BIGINT) AS total_positive,
               CAST(SUM(negative_comments) AS BIGINT) AS total_negative
        FROM gold GROUP BY channel_handle""",
    "video_list": """
        SELECT 'vid' || (doc_id % 20) AS video_id, '@ch' || ((doc_id % 20) % 4) AS channel_handle,
               MIN(published_at) AS published_at, video_title AS title, video_url
        FROM (SELECT *, CAST(comment_id AS BIGINT) AS doc_id FROM raw) GROUP BY ALL""",
    "uploads": f"""
        SELECT 'vid' || event_id AS video_id, '@ch' || (user_id % 4) AS channel_handle,
               'Channel ' || (user_id % 4) AS channel_name, 'Upload ' || event_id || ': ' || event_type AS title,
               {_ISO} AS published_at, '{WATCH_URL_PREFIX}vid' || event_id AS video_url, date_trunc('second', ts) AS posted,
               CAST(CASE WHEN k % 3 = 0 THEN (k % 5 + 1) * 3600 ELSE 0 END + k * 60 + event_id % 60 AS BIGINT) AS duration_seconds,
               views, CAST(floor(views / (k + 1)) AS BIGINT) AS likes, CAST(k * 2 AS BIGINT) AS comments
        FROM (SELECT *, {_PROP} AS k, CAST(floor(value * 100) AS BIGINT) AS views FROM events)""",
    "transcripts": f"""
        SELECT 'vid' || doc_id AS video_id, text,
               CAST(len(list_filter(string_split_regex(text, '{_SPACE}+'), lambda t: t <> '')) AS INTEGER) AS word_count
        FROM documents""",
    "engagement": """
        SELECT video_id, channel_handle, title, views, likes, comments, duration_seconds,
               CASE WHEN views <> 0 THEN least(1.0::DOUBLE, CAST(ROUND(CAST((likes + comments) / CAST(views AS DOUBLE)
                    AS DECIMAL(28,12)), 6) AS DOUBLE)) END AS engagement_rate,
               video_id IN (SELECT video_id FROM transcripts) AS has_transcript
        FROM uploads""",
    "summary": """
        SELECT channel_handle, COUNT(*) AS videos, CAST(SUM(views) AS BIGINT) AS total_views,
               CAST(SUM(likes) AS BIGINT) AS total_likes, CAST(SUM(comments) AS BIGINT) AS total_comments,
               COUNT(*) FILTER (has_transcript) AS videos_with_transcript
        FROM engagement GROUP BY channel_handle""",
    "unclean": """
        SELECT * REPLACE (CASE WHEN like_count > 0 THEN comment_id END AS comment_id, trim(text, ' ') AS text) FROM raw""",
}
_NEEDS = {
    "silver": ["raw"], "scored": ["silver"], "gold": ["scored"], "kpis": ["gold"], "video_list": ["raw"],
    "engagement": ["uploads", "transcripts"], "summary": ["engagement"], "unclean": ["raw"],
}


def _with(names: list[str], body: str) -> str:
    order: list[str] = []

    def add(name: str) -> None:
        for n in _NEEDS.get(name, []):
            add(n)
        if name not in order:
            order.append(name)

    for n in names:
        add(n)
    ctes = ",\n".join(f"{n} AS ({_CTE[n]})" for n in order)
    return f"WITH {ctes}\n{body}" if order else body


_RAW_COLUMNS = (
    "comment_id, video_id, channel_handle, author_name, text, like_count, reply_count, published_at, is_reply, "
    "parent_id, video_title, video_url, ingested_at"
)


def _stamp(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S') AS {column}"


_SILVER_ROWS = _with(["silver"], f"SELECT * REPLACE ({_stamp('published_at').replace(' AS published_at', '')} AS published_at) FROM silver")
_GOLD_ROWS = _with(["gold"], "SELECT * REPLACE (strftime(latest_comment_at, '%Y-%m-%d %H:%M:%S') AS latest_comment_at) FROM gold")
_RAW_ROWS = _with(["raw"], f"SELECT {_RAW_COLUMNS} FROM raw")

_HANDLE = """CASE doc_id % 4 WHEN 0 THEN '@' || source WHEN 1 THEN '@' || source WHEN 2 THEN '@' || source
             ELSE '@@' || lang || '/' || source END"""

# ``fresh``: the thread on top of each page that was landed again.
_FRESH = """(SELECT video_id, slot // 3 // 5 AS page, MIN(slot) - 0.5 AS slot,
                    'new-' || video_id || '-' || (slot // 3 // 5 + 1) AS comment_id FROM raw GROUP BY ALL)"""


def _documents(fresh: bool) -> str:
    more = f"""UNION ALL SELECT video_id, CAST(page // 2 AS INTEGER), slot, '[late]: fresh (likes: 0)' FROM {_FRESH}""" if fresh else ""
    count = f"""+ (SELECT COUNT(*) FROM {_FRESH} f WHERE f.video_id = v.video_id)""" if fresh else ""
    return _with(["raw", "video_list"], f"""
    , lines AS (
        SELECT video_id, CAST(slot // 3 // 5 // 2 AS INTEGER) AS part, CAST(slot AS DOUBLE) AS slot,
               CASE WHEN is_reply THEN '  -> ' ELSE '' END || '[' || author_name || ']: ' || text
                    || ' (likes: ' || like_count || ')' AS line
        FROM raw
        {more}
        UNION ALL
        SELECT v.video_id, 0, -1.0, 'Title: ' || title || chr(10) || 'Video URL: ' || v.video_url || chr(10)
               || 'Channel: ' || v.channel_handle || chr(10) || 'Published: ' || substring(v.published_at, 1, 10) || chr(10)
               || 'Total Comments Fetched: ' || ((SELECT COUNT(*) FROM raw r WHERE r.video_id = v.video_id AND NOT is_reply) {count})
               || chr(10) || chr(10) || 'COMMENTS:'
        FROM video_list v),
    parts AS (SELECT video_id, part, string_agg(line, chr(10) ORDER BY slot) AS body FROM lines GROUP BY video_id, part)
    SELECT p.video_id, ltrim(channel_handle, '@') AS channel_slug,
           p.video_id || '_Video_' || substring(p.video_id, 4) || '_intro_tips.txt' AS file_name, part, body
    FROM parts p JOIN video_list v ON v.video_id = p.video_id""").replace(")\n\n    , lines", "),\n    lines")


_DOCUMENTS = _documents(False)


def _batches(slug: str) -> str:
    return _with(["uploads"], f"""
        SELECT {slug}, video_id, 'batch_' || CASE WHEN n < 1000 THEN lpad(CAST(n AS VARCHAR), 4, '0') ELSE CAST(n AS VARCHAR) END AS batch
        FROM (SELECT *, (row_number() OVER (PARTITION BY channel_handle ORDER BY published_at DESC, md5(video_id)) - 1) // 50 + 1 AS n
              FROM uploads)""")


_DASH = {
    "channel_kpis": "SELECT * FROM kpis",
    "sentiment_ranked": "SELECT channel_handle, title, sentiment_score, total_comments FROM gold",
    "top_commented": """SELECT channel_handle, title, total_comments, avg_likes_per_comment FROM
        (SELECT * FROM gold ORDER BY total_comments DESC, video_id LIMIT 10)""",
    "top_engagement": """SELECT channel_handle, title, avg_likes_per_comment, total_comments FROM
        (SELECT * FROM gold WHERE total_comments >= 3 ORDER BY avg_likes_per_comment DESC, video_id LIMIT 10)""",
    "sentiment_breakdown": """
        SELECT channel_handle, title, 'Positive' AS sentiment_type, positive_comments AS comment_count FROM gold
        UNION ALL SELECT channel_handle, title, 'Negative', negative_comments FROM gold
        UNION ALL SELECT channel_handle, title, 'Neutral', neutral_comments FROM gold""",
    "all_metrics": """SELECT channel_handle, title, total_comments, sentiment_score, positive_comments, negative_comments,
        neutral_comments, avg_likes_per_comment, total_replies, CAST(CAST(latest_comment_at AS DATE) AS VARCHAR) AS last_activity FROM gold""",
}


def _best(by: str) -> str:
    return _with(["gold"], f"SELECT video_id, channel_handle, title, video_url, {by} FROM gold ORDER BY {by} DESC, video_id LIMIT 5")


def _ranked(dataset: str, where: str, by: str) -> str:
    columns = "title, total_comments, avg_likes_per_comment"
    return f"""
        SELECT '{dataset}' AS dataset, 'after_limit' AS scope, {columns} FROM
            (SELECT * FROM gold WHERE {where} ORDER BY {by} DESC, video_id LIMIT 10) WHERE channel_handle = '@ch1'
        UNION ALL SELECT '{dataset}', 'before_limit', {columns} FROM
            (SELECT * FROM gold WHERE {where} AND channel_handle = '@ch1' ORDER BY {by} DESC, video_id LIMIT 10)"""


def _check(table: str, label: str, bad: str, source: str) -> str:
    return f"""SELECT '{table}: {label}' AS check_name, {bad} = 0 AS passed, CAST({bad} AS BIGINT) AS failing_rows,
        CASE WHEN {bad} > 0 THEN {bad} || ' rows' END AS detail FROM {source}"""


def _flag(table: str, label: str, passed: str, source: str) -> str:
    return f"""SELECT '{table}: {label}' AS check_name, {passed} AS passed, CAST(0 AS BIGINT) AS failing_rows,
        CAST(NULL AS VARCHAR) AS detail FROM {source}"""


_VIDEO_CHECKS = "\nUNION ALL ".join([
    _flag("videos", "has rows", "COUNT(*) > 0", "uploads"),
    _flag("videos", "has video_id", "COUNT(*) >= 0", "uploads"),
    _check("videos", "no null video_id", "COUNT(*) FILTER (video_id IS NULL)", "uploads"),
    _check("videos", "duration_seconds >= 0", "COUNT(*) FILTER (duration_seconds < 0)", "uploads"),
    _flag("transcripts", "has rows", "COUNT(*) > 0", "transcripts"),
    _check("transcripts", "word_count > 0", "COUNT(*) FILTER (word_count <= 0)", "transcripts"),
    _check("transcripts", "word_count >= 100", "COUNT(*) FILTER (word_count < 100)", "transcripts"),
    _flag("metrics", "has rows", "COUNT(*) > 0", "engagement"),
    _flag("metrics", "has has_transcript", "COUNT(has_transcript) >= 0", "engagement"),
    _check("metrics", "engagement_rate in [0, 1]", "COUNT(*) FILTER (engagement_rate < 0 OR engagement_rate > 1)", "engagement"),
    _flag("summary", "has rows", "COUNT(*) > 0", "summary"),
    _check("summary", "total_views > 0", "(COUNT(*) - COUNT(*) FILTER (total_views > 0))", "summary"),
])

_TOKENS = r"string_split_regex(lower(text), '[^\p{L}\p{M}\p{N}'']+')"
_CITED = "comment_id, channel_handle, title, video_url, text"
_SEARCH = ["best", "trash", "love", "ciónasmi", "über"]


def _expectation(name: str, holds: str) -> str:
    return _with(["unclean"], f"""SELECT '{name}' AS expectation, 'warn' AS action, COUNT(*) FILTER ({holds}) AS passed_rows,
        COUNT(*) - COUNT(*) FILTER ({holds}) AS failed_rows FROM unclean""")


_SQL: dict[str, str] = {
    "src_stream_json": _RAW_ROWS,
    "bronze_raw_comments": _with(["raw"], f"SELECT {_RAW_COLUMNS}, TRUE AS stamped FROM raw"),
    "sink_ndjson_roundtrip": _RAW_ROWS,
    "silver_comments": _SILVER_ROWS,
    "silver_comments_stream": _SILVER_ROWS,
    "silver_compacted": _SILVER_ROWS,
    "silver_compacted_channel": f"SELECT * FROM ({_SILVER_ROWS}) WHERE channel_handle = '@ch1'",
    "silver_dedup_runs": f"""SELECT * REPLACE (CAST(like_count + CAST(comment_id AS BIGINT) % 3 AS BIGINT) AS like_count)
        FROM ({_SILVER_ROWS})""",
    "src_landed_videos": _with(["uploads"], "SELECT video_id, channel_handle, title, published_at, video_url FROM uploads"),
    "src_thread_pages": _with(["raw"], """
        SELECT comment_id, video_id, channel_handle, author_name, text, like_count,
               CASE WHEN is_reply THEN 0 ELSE reply_count END AS reply_count, published_at, is_reply, parent_id FROM raw"""),
    "flatten_threads": _with(["raw"], """
        SELECT comment_id, video_id, author_name, text, like_count, CASE WHEN is_reply THEN 0 ELSE reply_count END AS reply_count,
               published_at, is_reply, parent_id, CAST(slot // 300 + 1 AS INTEGER) AS page_no,
               CAST(slot % 300 AS INTEGER) AS page_pos, CAST(slot // 3 % 100 AS INTEGER) AS item_pos,
               CAST(slot % 3 AS INTEGER) AS reply_pos FROM raw"""),
    "flatten_videos": """
        SELECT '@ch' || ((event_id // 50 + 1) % 4) AS channel_handle, CAST(event_id // 50 + 1 AS INTEGER) AS page_no,
               CAST(event_id % 50 AS INTEGER) AS item_pos, 'vid' || event_id AS video_id FROM events""",
    "sink_video_batches": _batches("ltrim(channel_handle, '@') AS channel_slug"),
    "batch_of_50": _batches("channel_handle"),
    "assemble_video_document": _DOCUMENTS,
    "document_relanded": _documents(True),
    "run_documents_repeated": f"""
        SELECT file_name, CAST(SUM(len(string_split(body, chr(10)))) AS BIGINT) AS n_lines,
               CAST(SUM(len(string_split(body, chr(10) || '  -> ')) - 1) AS BIGINT) AS replies
        FROM ({_documents(True)}) GROUP BY file_name""",
    "limit_comments_relanded": _with(["raw"], f"""
        SELECT video_id, comment_id, is_reply, parent_id FROM (
            SELECT video_id, comment_id, is_reply, parent_id, CAST(slot AS DOUBLE) AS slot FROM raw
            UNION ALL SELECT video_id, comment_id, FALSE, NULL, slot FROM {_FRESH})
        QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY slot) <= 20"""),
    "run_outcomes": _with(["raw"], """
        SELECT CASE WHEN v % 5 = 0 THEN 'error' WHEN v % 7 = 0 OR v % 9 = 0 THEN 'skipped' ELSE 'fetched' END AS status, COUNT(*) AS videos
        FROM (SELECT DISTINCT CAST(substring(video_id, 4) AS BIGINT) AS v FROM raw) GROUP BY status"""),
    "dq_observe_and_drop": _with(["unclean"], """
        SELECT COUNT(*) AS rows, COUNT(*) FILTER (comment_id IS NULL) AS valid_comment_id,
               COUNT(*) FILTER (NOT coalesce(length(text) > 0, FALSE)) AS has_text,
               COUNT(*) FILTER (coalesce(length(text) > 0, FALSE)) AS kept_rows FROM unclean"""),
    "sink_video_documents": f"SELECT file_name, part, body FROM ({_DOCUMENTS})",
    "catalog_schemas": _with(["gold"], """
        SELECT 'bronze' AS layer, 'raw_comments' AS table_name, COUNT(*) AS row_count FROM raw
        UNION ALL SELECT 'silver', 'comments', COUNT(*) FROM silver
        UNION ALL SELECT 'gold', 'comment_metrics', COUNT(*) FROM gold
        UNION ALL SELECT unnest(['bronze', 'silver', 'gold', 'landing']), NULL, NULL"""),
    "fn_channel_handle": f"SELECT doc_id, {_HANDLE} AS handle FROM documents",
    "fn_channel_slug": f"SELECT doc_id, replace(ltrim({_HANDLE}, '@'), '/', '_') AS slug FROM documents",
    "fn_sanitise_title": rf"""
        SELECT doc_id, substring(regexp_replace(regexp_replace(regexp_replace(text,
               '[^\p{{L}}\p{{N}}_\-\s\x0b\x1c-\x1f\x{{85}}\p{{Z}}]', '', 'g'),
               '^{_SPACE}+|{_SPACE}+$', '', 'g'), '{_SPACE}+', '_', 'g'), 1, 60) AS file_title FROM documents""",
    "fn_preview": "SELECT doc_id, substring(text, 1, 55) AS title_preview, substring(text, 1, 80) AS text_preview FROM documents",
    "fn_try_timestamp": """
        SELECT event_id, strftime(CASE event_id % 4 WHEN 0 THEN date_trunc('second', ts)
               WHEN 1 THEN date_trunc('second', ts) - INTERVAL 330 MINUTE
               WHEN 2 THEN date_trunc('day', ts) END, '%Y-%m-%d %H:%M:%S') AS published_at FROM events""",
    "limit_comments_per_video": _with(["raw"], """
        SELECT video_id, comment_id, is_reply, parent_id FROM raw
        QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY slot) <= 20"""),
    "limit_newest_videos": _with(["uploads"], """
        SELECT video_id, channel_handle, title, published_at, video_url FROM uploads
        QUALIFY row_number() OVER (PARTITION BY channel_handle ORDER BY published_at DESC, md5(video_id)) <= 7"""),
    "ingest_outcomes": f"""
        SELECT CASE WHEN event_type = 'error' AND k % 3 IN (0, 1) THEN 'skipped' WHEN event_type = 'error' THEN 'error'
                    WHEN k % 10 = 0 THEN 'skipped' ELSE 'fetched' END AS status, COUNT(*) AS videos
        FROM (SELECT *, {_PROP} AS k FROM events) GROUP BY status""",
    "join_reply_parent": _with(["silver"], """
        SELECT r.video_id, r.parent_id, r.comment_id AS reply_id, r.author_name AS reply_author, r.text AS reply_text,
               r.like_count AS reply_likes, p.author_name AS parent_author, p.like_count AS parent_likes
        FROM silver r JOIN silver p ON r.video_id = p.video_id AND r.parent_id = p.comment_id
        WHERE r.is_reply AND NOT p.is_reply"""),
    "join_comment_video": _with(["raw"], "SELECT comment_id, video_id, video_title, video_url FROM raw"),
    "videos_without_comments": _with(["uploads", "raw"], """
        SELECT video_id, channel_handle, title, published_at, video_url FROM uploads
        WHERE video_id NOT IN (SELECT video_id FROM raw)"""),
    "silver_dedup": _with(["raw"], f"""
        SELECT {_RAW_COLUMNS.replace('like_count', 'like_count + 1 AS like_count').replace(', ingested_at', '')},
               strftime(posted + INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%SZ') AS ingested_at FROM raw"""),
    "score_sentiment": _with(["scored"], "SELECT comment_id, sentiment FROM scored"),
    "score_sentiment_lexjoin_relanded": _with(["unclean"], f"""
        SELECT comment_id, CASE WHEN pos > neg THEN 'positive' WHEN neg > pos THEN 'negative' ELSE 'neutral' END AS sentiment
        FROM (SELECT comment_id, len(list_filter(toks, lambda t: t IN ({_words(POSITIVE_WORDS)}))) AS pos,
                     len(list_filter(toks, lambda t: t IN ({_words(NEGATIVE_WORDS)}))) AS neg
              FROM (SELECT comment_id, string_split_regex(lower(text), '[^a-z'']+') AS toks FROM unclean
                    UNION ALL SELECT comment_id, string_split_regex(lower(text), '[^a-z'']+') FROM unclean))"""),
    "score_sentiment_lexjoin": _with(["scored"], "SELECT comment_id, sentiment FROM scored"),
    "gold_comment_metrics": _GOLD_ROWS,
    "gold_incremental": _GOLD_ROWS,
    "gold_refresh_touched": _GOLD_ROWS,
    "dash_filtered_by_channel": _with(["gold"], f"""
        SELECT * FROM ({_ranked('top_commented', 'TRUE', 'total_comments')}
        UNION ALL {_ranked('top_engagement', 'total_comments >= 3', 'avg_likes_per_comment')})"""),
    "dq_valid_comment_id": _expectation("valid_comment_id", "comment_id IS NOT NULL"),
    "dq_has_text": _expectation("has_text", "length(text) > 0"),
    "dq_quarantine": _with(["unclean"], """
        SELECT video_id, author_name, published_at, concat_ws(',', CASE WHEN comment_id IS NULL THEN 'valid_comment_id' END,
               CASE WHEN NOT coalesce(length(text) > 0, FALSE) THEN 'has_text' END) AS violated
        FROM unclean WHERE comment_id IS NULL OR NOT coalesce(length(text) > 0, FALSE)"""),
    "dq_not_empty": _with(["gold"], "SELECT * FROM (" + "\nUNION ALL ".join(
        _flag(name, "has rows", "COUNT(*) > 0", source)
        for name, source in (("landing", "raw"), ("raw", "raw"), ("silver", "silver"), ("gold", "gold"))) + ")"),
    "dq_predicates": _with(["summary"], f"SELECT * FROM ({_VIDEO_CHECKS})"),
    "dq_report": _with(["summary"], f"""
        SELECT COUNT(*) + 1 AS total, COUNT(*) FILTER (passed) AS passed, COUNT(*) FILTER (NOT passed) + 1 AS failed
        FROM ({_VIDEO_CHECKS})"""),
    "dq_coverage": _with(["uploads", "transcripts"], """
        SELECT expected, covered, CAST(ROUND(CAST(covered / CAST(expected AS DOUBLE) AS DECIMAL(18,9)), 4) AS DOUBLE) AS coverage,
               covered / CAST(expected AS DOUBLE) > 0.5 AS passed
        FROM (SELECT COUNT(DISTINCT video_id) AS expected,
                     COUNT(DISTINCT video_id) FILTER (video_id IN (SELECT video_id FROM transcripts)) AS covered FROM uploads)"""),
    "q_most_positive_video": _best("positive_comments"),
    "q_highest_engagement": _best("avg_likes_per_comment"),
    "q_most_discussed": _best("total_comments"),
    "q_pos_vs_neg": _with(["gold"], "SELECT video_id, channel_handle, title, positive_comments, negative_comments FROM gold"),
    "q_most_liked_comments": _with(["silver"], """
        SELECT comment_id, channel_handle, title, video_url, author_name, text, like_count FROM silver
        ORDER BY like_count DESC, comment_id LIMIT 10"""),
    "q_recent_video_comments": _with(["silver", "video_list"], f"""
        SELECT comment_id, video_id, title, author_name, text, like_count, {_stamp('published_at')}, is_reply FROM silver
        WHERE video_id = (SELECT video_id FROM video_list ORDER BY published_at DESC, video_id DESC LIMIT 1)"""),
    "q_recent_video_comments_by_channel": _with(["silver"], f"""
        SELECT comment_id, video_id, title, author_name, text, like_count, {_stamp('published_at')}, is_reply FROM silver
        WHERE video_id = (SELECT video_id FROM silver WHERE channel_handle = '@ch1'
                          ORDER BY silver.published_at DESC, video_id DESC LIMIT 1)"""),
    "q_best_worst_sentiment": _with(["gold"], """
        SELECT b.video_id AS best_video, b.sentiment_score AS best_score, w.video_id AS worst_video, w.sentiment_score AS worst_score
        FROM (SELECT * FROM gold ORDER BY sentiment_score DESC, video_id LIMIT 1) b,
             (SELECT * FROM gold ORDER BY sentiment_score, video_id LIMIT 1) w"""),
    "q_negative_comments": _with(["scored"], """
        SELECT comment_id, channel_handle, title, video_url, author_name, text, like_count FROM scored
        WHERE sentiment = 'negative'"""),
    "q_compare_channels": _with(["kpis"], """
        SELECT *, rank() OVER (ORDER BY avg_sentiment DESC) AS sentiment_rank,
               rank() OVER (ORDER BY total_comments DESC) AS volume_rank FROM kpis"""),
    "q_reply_coverage": _with(["silver"], """
        SELECT video_id, announced_replies, landed_replies,
               CAST(ROUND(CAST(landed_replies / CAST(nullif(announced_replies, 0) AS DOUBLE) AS DECIMAL(18,9)), 4) AS DOUBLE) AS coverage
        FROM (SELECT video_id, CAST(coalesce(SUM(reply_count) FILTER (NOT is_reply), 0) AS BIGINT) AS announced_replies,
                     COUNT(*) FILTER (is_reply) AS landed_replies FROM silver GROUP BY video_id)"""),
    "q_sentiment_trend": _with(["scored"], """
        , periods AS (
            SELECT channel_handle, date_trunc('hour', published_at) AS period, COUNT(*) AS comments,
                   CAST(ROUND(CAST(SUM(CASE sentiment WHEN 'positive' THEN 1 WHEN 'negative' THEN -1 ELSE 0 END)
                        / CAST(COUNT(*) AS DOUBLE) AS DECIMAL(18,9)), 3) AS DECIMAL(15,3)) AS score
            FROM scored WHERE NOT is_reply GROUP BY ALL)
        SELECT channel_handle, strftime(period, '%Y-%m-%d %H:%M:%S') AS period, comments, CAST(score AS DOUBLE) AS score,
               CAST(ROUND(CAST(CAST(SUM(score) OVER w AS DOUBLE) / COUNT(*) OVER w AS DECIMAL(18,9)), 3) AS DOUBLE) AS moving_score
        FROM periods WINDOW w AS (PARTITION BY channel_handle ORDER BY periods.period ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
        """).replace(")\n\n        , periods", "),\n        periods"),
    "q_reply_rate": _with(["gold"], """
        SELECT video_id, channel_handle, title, total_replies, total_comments,
               CAST(ROUND(CAST(total_replies / CAST(total_comments AS DOUBLE) AS DECIMAL(18,9)), 3) AS DOUBLE) AS reply_rate FROM gold"""),
    "r_comments_mentioning": _with(["silver"], f"""
        SELECT {_CITED} FROM silver WHERE list_has_any({_TOKENS}, [{_words(_SEARCH)}])"""),
    "r_complaint_terms": _with(["scored"], f"""
        SELECT term, COUNT(*) AS occurrences FROM
            (SELECT unnest({_TOKENS}) AS term FROM scored WHERE sentiment = 'negative')
        WHERE term <> '' AND term NOT IN ({", ".join("'" + w + "'" for w in STOP_WORDS)})
        GROUP BY term ORDER BY occurrences DESC, term LIMIT 20"""),
    "r_followup_requests": _with(["silver"], f"""
        SELECT {_CITED} FROM silver WHERE contains(lower(text), 'and the') OR contains(lower(text), 'would love')
               OR contains(lower(text), 'part two')"""),
    "r_bm25_topk": _with(["silver"], f"""
        , docs AS (SELECT *, list_filter({_TOKENS}, lambda t: t <> '') AS toks FROM silver),
        stats AS (SELECT CAST(COUNT(*) AS DOUBLE) AS n, AVG(len(toks)) AS avg_len FROM docs),
        hits AS (SELECT comment_id, len(toks) AS len, q, len(list_filter(toks, lambda t: t = q)) AS tf
                 FROM docs, (SELECT unnest([{_words(_SEARCH)}]) AS q)),
        dfs AS (SELECT q, CAST(COUNT(*) AS DOUBLE) AS df FROM hits WHERE tf > 0 GROUP BY q),
        scores AS (SELECT comment_id, SUM(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2
                          / (tf + 1.2 * (0.25 + 0.75 * len / avg_len))) AS score
                   FROM hits JOIN dfs USING (q), stats WHERE tf > 0 GROUP BY comment_id)
        SELECT comment_id, channel_handle, title, video_url, text, ROUND(score, 6) AS score
        FROM silver JOIN scores USING (comment_id) ORDER BY score DESC, comment_id LIMIT 10""").replace(
            ")\n\n        , docs", "),\n        docs"),
    "silver_videos": _with(["uploads"], f"""
        SELECT video_id, channel_handle, channel_name, title, video_url, strftime(posted, '%Y-%m-%d %H:%M:%S') AS published_at,
               duration_seconds, views, likes, comments FROM uploads"""),
    "flatten_video_items": _with(["uploads"], """
        SELECT video_id, channel_handle, channel_name, title, video_url, strftime(posted, '%Y-%m-%d %H:%M:%S') AS published_at,
               duration_seconds, views, likes, comments, 'UC' || ltrim(channel_handle, '@ch') AS channel_id, 'video' AS kind FROM uploads"""),
    "flatten_channels": """
        SELECT DISTINCT '@user' || user_id AS channel_handle, 'UC' || user_id AS channel_id, 'User ' || user_id AS channel_name,
               'UU' || user_id AS uploads_playlist_id FROM events""",
    "text_word_count": _with(["transcripts"], "SELECT video_id, word_count FROM transcripts"),
    "video_engagement": _with(["engagement"], "SELECT * FROM engagement"),
    "channel_summary": _with(["summary"], "SELECT * FROM summary"),
}
for _name, _body in _DASH.items():
    _SQL[f"dash_{_name}"] = _with(["kpis" if _name == "channel_kpis" else "gold"], _body)
    _SQL[f"dash_{_name}_by_channel"] = _with(
        ["kpis" if _name == "channel_kpis" else "gold"], f"SELECT * FROM ({_body}) WHERE channel_handle = '@ch1'")


_SQL["run_end_to_end"] = _SQL["run_repeated"] = _GOLD_ROWS
_SQL["run_documents_in_parts"] = _SQL["run_documents_repeated"]
_SQL |= {
    "run_pages_in_parts": _with(["raw"], f"""
        SELECT comment_id, video_id, text, is_reply, parent_id, video_title FROM raw
        UNION ALL SELECT comment_id, video_id, 'fresh', FALSE, NULL, 'Video #' || substring(video_id, 4) || ': intro & tips!' FROM {_FRESH}"""),
    "src_stream_rescued": _with(["raw"], """
        SELECT CASE WHEN i % 11 <> 0 THEN comment_id END AS comment_id,
               CASE WHEN i % 11 <> 0 AND i % 5 <> 0 THEN like_count END AS like_count,
               CASE WHEN i % 11 <> 0 THEN text END AS text,
               CASE WHEN i % 11 <> 0 AND i % 7 = 0 THEN author_name END AS pinned_by,
               CASE WHEN i % 11 <> 0 AND i % 5 = 0 THEN 'many' END AS like_text,
               CASE WHEN i % 11 = 0 THEN 'broken ' || comment_id END AS corrupt
        FROM (SELECT *, CAST(comment_id AS BIGINT) AS i FROM raw)"""),
    "src_stream_schema_versions": """
        SELECT CAST(v AS BIGINT) AS version, field, type, declared FROM (VALUES
            (0, 'comment_id', 'string', TRUE), (0, 'video_id', 'string', TRUE), (0, 'channel_handle', 'string', TRUE),
            (0, 'author_name', 'string', TRUE), (0, 'text', 'string', TRUE), (0, 'like_count', 'bigint', TRUE),
            (0, 'reply_count', 'int', TRUE), (0, 'published_at', 'string', TRUE), (0, 'is_reply', 'boolean', TRUE),
            (0, 'parent_id', 'string', TRUE), (0, 'video_title', 'string', TRUE), (0, 'video_url', 'string', TRUE),
            (0, 'ingested_at', 'string', TRUE)) AS t (v, field, type, declared)
        UNION ALL SELECT DISTINCT 1, field, type, FALSE FROM (
            SELECT CASE WHEN event_id % 11 = 0 THEN '_corrupt_record' END AS field, 'STRING' AS type FROM events
            UNION ALL SELECT CASE WHEN event_id % 11 <> 0 AND event_id % 5 = 0 THEN 'like_count' END, 'STRING' FROM events
            UNION ALL SELECT CASE WHEN event_id % 11 <> 0 AND event_id % 7 = 0 THEN 'pinned' END, 'OBJECT<by: STRING>' FROM events)
        WHERE field IS NOT NULL""",
    "sink_document_files": f"""
        SELECT channel_slug || '/' || file_name AS file, string_agg(body, chr(10) ORDER BY part) AS body
        FROM ({_DOCUMENTS}) GROUP BY ALL""",
    "sink_comment_file_per_video": _with(["raw"], "SELECT video_id || '.json' AS file, comment_id, text, parent_id FROM raw"),
    "sink_batch_files": _with(["uploads"], """
        SELECT ltrim(channel_handle, '@') || '/batch_' || CASE WHEN n < 1000 THEN lpad(CAST(n AS VARCHAR), 4, '0') ELSE CAST(n AS VARCHAR) END
                   || '.json' AS file,
               string_agg(video_id, ',' ORDER BY published_at DESC, md5(video_id)) AS video_ids
        FROM (SELECT *, (row_number() OVER (PARTITION BY channel_handle ORDER BY published_at DESC, md5(video_id)) - 1) // 50 + 1 AS n
              FROM uploads) GROUP BY channel_handle, n"""),
    "limit_newest_file_order": _with(["uploads"], """
        SELECT video_id, channel_handle, title, published_at, video_url FROM
            (SELECT *, CAST(substring(video_id, 4) AS BIGINT) AS i FROM uploads)
        QUALIFY row_number() OVER (PARTITION BY channel_handle ORDER BY i % 13, i DESC) <= 7"""),
    "dq_stream_quarantine": _with(["unclean"], """
        SELECT CASE WHEN comment_id IS NULL THEN 'quarantine' ELSE 'kept' END AS went_to, comment_id, video_id, author_name,
               replace(replace(published_at, 'T', ' '), 'Z', '') AS published_at,
               CASE WHEN comment_id IS NULL THEN 'valid_comment_id' ELSE '' END AS violated
        FROM unclean WHERE length(text) > 0"""),
}
_SQL["r_bm25_topk_relanded"] = _SQL["r_bm25_index_topk_relanded"] = _with(["unclean"], f"""
        , docs AS (SELECT *, list_filter({_TOKENS}, lambda t: t <> '') AS toks FROM
                   (SELECT text, video_title AS title FROM unclean UNION ALL SELECT text, video_title FROM unclean)),
        numbered AS (SELECT *, row_number() OVER () AS row FROM docs),
        stats AS (SELECT CAST(COUNT(*) AS DOUBLE) AS n, AVG(len(toks)) AS avg_len FROM docs),
        hits AS (SELECT row, len(toks) AS len, q, len(list_filter(toks, lambda t: t = q)) AS tf
                 FROM numbered, (SELECT unnest([{_words(_SEARCH)}]) AS q)),
        dfs AS (SELECT q, CAST(COUNT(*) AS DOUBLE) AS df FROM hits WHERE tf > 0 GROUP BY q),
        scores AS (SELECT row, ROUND(SUM(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2
                          / (tf + 1.2 * (0.25 + 0.75 * len / avg_len))), 6) AS score
                   FROM hits JOIN dfs USING (q), stats WHERE tf > 0 GROUP BY row)
        SELECT score, text, title FROM numbered JOIN scores USING (row) ORDER BY score DESC LIMIT 10""").replace(
            ")\n\n        , docs", "),\n        docs")
_SQL["r_bm25_index_topk"] = _SQL["r_bm25_topk"]
_SQL["r_bm25_topk_by_channel"] = _SQL["r_bm25_index_topk_by_channel"] = (
    _SQL["r_bm25_topk"].replace("AS toks FROM silver)", "AS toks FROM silver WHERE channel_handle = '@ch1')"))


def all_sql() -> dict[str, str]:
    return dict(_SQL)
