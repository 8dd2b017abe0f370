"""The six dashboard datasets as functions of the per-video metrics, with an optional channel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chorale.operators.channels import for_channel

# Lengths of the rankings and the least volume a video needs for the engagement ranking.
TOP_VIDEOS = 10
MIN_COMMENTS = 3
SENTIMENT_TYPES = {
    "Positive": "positive_comments", "Negative": "negative_comments", "Neutral": "neutral_comments",
}


def _likes() -> Column:
    return F.round("avg_likes_per_comment", 2).alias("avg_likes_per_comment")


def _score() -> Column:
    return F.round("sentiment_score", 3).alias("sentiment_score")


def channel_kpis(gold: DataFrame, channel: str | None = None) -> DataFrame:
    """Totals per channel; means are unweighted over videos and taken in decimal arithmetic, so they
    do not depend on the order in which partial sums arrive."""
    engagement = F.round(F.avg(F.col("avg_likes_per_comment").cast("decimal(18,2)")), 2).cast("double")
    return for_channel(gold, channel).groupBy("channel_handle").agg(
        F.count(F.lit(1)).alias("videos_analyzed"),
        F.sum("total_comments").alias("total_comments"),
        F.round(F.avg("sentiment_score"), 3).alias("avg_sentiment"),
        engagement.alias("avg_engagement"),
        F.sum("positive_comments").alias("total_positive"),
        F.sum("negative_comments").alias("total_negative"),
    )


def sentiment_ranked(gold: DataFrame, channel: str | None = None) -> DataFrame:
    rows = for_channel(gold, channel).orderBy(F.col("sentiment_score").desc_nulls_last(), "video_id")
    return rows.select("channel_handle", "title", _score(), "total_comments")


def _top(rows: DataFrame, by: str, channel: str | None, scope: str) -> DataFrame:
    """First ``TOP_VIDEOS`` by ``by``, ties by id.  The dashboard's channel choice acts on the finished
    ranking (``after_limit``); ``before_limit`` ranks within the channel."""
    if scope not in ("after_limit", "before_limit"):
        raise ValueError("scope must be 'after_limit' or 'before_limit'")
    if scope == "before_limit":
        rows = for_channel(rows, channel)
    ranked = rows.orderBy(F.col(by).desc_nulls_last(), "video_id").limit(TOP_VIDEOS)
    return for_channel(ranked, channel) if scope == "after_limit" else ranked


def top_commented(gold: DataFrame, channel: str | None = None, scope: str = "after_limit") -> DataFrame:
    top = _top(gold, "total_comments", channel, scope)
    return top.select("channel_handle", "title", "total_comments", _likes())


def top_engagement(gold: DataFrame, channel: str | None = None, scope: str = "after_limit") -> DataFrame:
    top = _top(gold.filter(F.col("total_comments") >= MIN_COMMENTS), "avg_likes_per_comment", channel, scope)
    return top.select("channel_handle", "title", _likes(), "total_comments")


def sentiment_breakdown(gold: DataFrame, channel: str | None = None) -> DataFrame:
    """Label counts as rows: one scan, where a union of three selects would read the table three times."""
    named = for_channel(gold, channel).select(
        "channel_handle", "title", *[F.col(c).alias(name) for name, c in SENTIMENT_TYPES.items()]
    )
    return named.unpivot(["channel_handle", "title"], list(SENTIMENT_TYPES), "sentiment_type", "comment_count")


def all_metrics(gold: DataFrame, channel: str | None = None) -> DataFrame:
    rows = for_channel(gold, channel).orderBy(F.col("total_comments").desc(), "video_id")
    return rows.select(
        "channel_handle", "title", "total_comments", _score(), *SENTIMENT_TYPES.values(), _likes(),
        "total_replies", F.to_date("latest_comment_at").alias("last_activity"),
    )
