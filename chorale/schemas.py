"""Declared schemas of every landed file and table (no inference anywhere)."""

from __future__ import annotations

# Field names and types of the landed files and the three table layers.
COMMENT_RECORD = (
    "comment_id string, video_id string, channel_handle string, author_name string, text string, "
    "like_count bigint, reply_count int, published_at string, is_reply boolean, parent_id string, "
    "video_title string, video_url string, ingested_at string"
)
RAW_COMMENTS = COMMENT_RECORD + ", _ingested_at timestamp"
SILVER_COMMENTS = (
    "comment_id string, video_id string, title string, video_url string, channel_handle string, "
    "author_name string, text string, like_count bigint, reply_count int, published_at timestamp, "
    "is_reply boolean, parent_id string, processed_at timestamp"
)
VIDEO_RECORD = (
    "video_id string, channel_handle string, channel_id string, channel_name string, "
    "raw_json string, ingested_at string"
)
# A landed comment page: the API response as text, under the ids the request was made for.
THREAD_PAGE_RECORD = (
    "video_id string, channel_handle string, page_no int, raw_json string, ingested_at string"
)
# Counts are read as strings: the API sends them as numbers in some parts and as text in others.
_COMMENT_BODY = (
    "struct<authorDisplayName: string, textOriginal: string, likeCount: string, publishedAt: string>"
)
REPLY_LIST = f"array<struct<id: string, snippet: {_COMMENT_BODY}>>"
THREAD_PAGE_JSON = (
    "struct<items: array<struct<id: string,"
    f" snippet: struct<totalReplyCount: string, topLevelComment: struct<snippet: {_COMMENT_BODY}>>,"
    f" replies: struct<comments: {REPLY_LIST}>>>,"
    " nextPageToken: string>"
)
# The comments of a parsed page, threads one after the other.
PAGE_COMMENTS = (
    "array<struct<comment_id: string, author_name: string, text: string, like_count: bigint, reply_count: int, "
    "published_at: string, parent_id: string, item_pos: int, reply_pos: int>>"
)
# Enough of a page to count its comments: texts are skipped while parsing.
THREAD_PAGE_SIZES_JSON = (
    "struct<items: array<struct<id: string, replies: struct<comments: array<struct<id: string>>>>>>"
)
VIDEO_ITEM_JSON = (
    "struct<id: string,"
    " snippet: struct<title: string, publishedAt: string>,"
    " statistics: struct<viewCount: string, likeCount: string, commentCount: string>,"
    " contentDetails: struct<duration: string>>"
)
VIDEO_ID_PAGE_JSON = (
    "struct<items: array<struct<contentDetails: struct<videoId: string>>>, nextPageToken: string>"
)
CHANNEL_ITEM_JSON = (
    "struct<id: string, snippet: struct<title: string>,"
    " contentDetails: struct<relatedPlaylists: struct<uploads: string>>>"
)
CHANNEL_PAGE_JSON = f"struct<items: array<{CHANNEL_ITEM_JSON}>>"
# Items are kept whole: what a details response holds beyond the fields read here is landed as well.
VIDEO_ITEM_PAGE_JSON = "struct<items: array<variant>>"

COMMENT_FIELDS = [f.split()[0] for f in COMMENT_RECORD.split(", ")]
GOLD_KEYS = ["video_id", "channel_handle", "title", "video_url"]
