"""Joins between comments, replies and videos.

No hint is given for a side that grows with the data: Spark broadcasts it when its measured size is
below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise sorts and merges, where the adaptive skew
join splits the partition of a hot video or hot parent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def replies_with_parents(comments: DataFrame) -> DataFrame:
    """Each reply next to its parent in the same video (orphans drop out).

    Only the columns shown travel through the shuffle, and the key is the parent, not the video, so one
    busy video spreads over all partitions.  Replies meet their parents without their texts, which they find again by a digest:
    what is shuffled are the different texts, combined map-side, and not one per reply.
    """
    replies = comments.filter(F.col("is_reply"))
    texts = replies.filter(F.col("text").isNotNull()).select("text").distinct()
    texts = texts.select(F.unhex(F.sha2("text", 256)).alias("_text"), F.col("text").alias("reply_text"))
    replies = replies.select(
        F.col("video_id"), F.col("parent_id"), F.col("comment_id").alias("reply_id"),
        F.col("author_name").alias("reply_author"), F.unhex(F.sha2("text", 256)).alias("_text"),
        F.col("like_count").alias("reply_likes"),
    )
    parents = comments.filter(~F.col("is_reply")).select(
        F.col("video_id"), F.col("comment_id").alias("parent_id"),
        F.col("author_name").alias("parent_author"), F.col("like_count").alias("parent_likes"),
    )
    matched = replies.join(parents, ["video_id", "parent_id"])
    return matched.join(texts, "_text", "left").select(
        "video_id", "parent_id", "reply_id", "reply_author", "reply_text", "reply_likes", "parent_author", "parent_likes")


def one_row_per_video(videos: DataFrame) -> DataFrame:
    """Landed batches may overlap: keep one row per ``video_id``, the last by publication and title."""
    rest = [c for c in videos.columns if c != "video_id"]
    best = F.max(F.struct(F.col("published_at"), *[F.col(c) for c in rest if c != "published_at"])).alias("_v")
    return videos.groupBy("video_id").agg(best).select("video_id", *[F.col(f"_v.{c}").alias(c) for c in rest])


def attach_videos(comments: DataFrame, videos: DataFrame) -> DataFrame:
    """Put ``video_title`` and ``video_url`` on every comment; ``videos`` has one row per id."""
    dim = videos.select("video_id", F.col("title").alias("video_title"), "video_url")
    return comments.join(dim, "video_id")


def videos_without_comments(videos: DataFrame, comments: DataFrame) -> DataFrame:
    """Videos no comment names.  Ids are made unique map-side first, so a hot video is one row per task."""
    return videos.join(comments.select("video_id").distinct(), "video_id", "left_anti")


def flag_present(left: DataFrame, right: DataFrame, key: str, flag: str) -> DataFrame:
    """Boolean ``flag``: does ``right`` hold the key?  ``right`` is reduced to its keys first."""
    keys = right.select(key).distinct().withColumn("_present", F.lit(True))
    return left.join(keys, key, "left").withColumn(flag, F.col("_present").isNotNull()).drop("_present")
