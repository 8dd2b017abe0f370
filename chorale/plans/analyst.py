"""The analysts' standard questions over metrics (``gold``), comments (``silver``) or scored comments.

Each takes an optional ``channel``.  Rankings break ties by id so that answers repeat.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chorale.operators.channels import for_channel
from chorale.operators.positions import rank_descending
from chorale.session import materialise


def _best(gold: DataFrame, by: str, k: int, channel: str | None) -> DataFrame:
    ranked = for_channel(gold, channel).orderBy(F.col(by).desc_nulls_last(), "video_id").limit(k)
    return ranked.select("video_id", "channel_handle", "title", "video_url", by)


def most_positive_videos(gold: DataFrame, k: int = 1, channel: str | None = None) -> DataFrame:
    return _best(gold, "positive_comments", k, channel)


def highest_engagement(gold: DataFrame, k: int = 1, channel: str | None = None) -> DataFrame:
    return _best(gold, "avg_likes_per_comment", k, channel)


def most_discussed(gold: DataFrame, k: int = 1, channel: str | None = None) -> DataFrame:
    return _best(gold, "total_comments", k, channel)


def positive_vs_negative(gold: DataFrame, channel: str | None = None) -> DataFrame:
    return for_channel(gold, channel).select(
        "video_id", "channel_handle", "title", "positive_comments", "negative_comments"
    )


def most_liked_comments(silver: DataFrame, k: int = 10, channel: str | None = None) -> DataFrame:
    likes = [F.col("like_count").desc_nulls_last(), F.col("comment_id").asc()]
    top = for_channel(silver, channel).orderBy(*likes).limit(k)
    return top.select("comment_id", "channel_handle", "title", "video_url", "author_name", "text", "like_count")


def recent_video_comments(silver: DataFrame, videos: DataFrame | None = None, channel: str | None = None) -> DataFrame:
    """All comments of the newest video: by its publication in ``videos``, else by its latest comment.

    The newest id is one value (a scalar subquery), pushed as a filter, so no join touches the comments.
    """
    source = for_channel(videos if videos is not None else silver, channel)
    newest = source.agg(F.max(F.struct("published_at", "video_id")).alias("m")).select("m.video_id")
    rows = for_channel(silver, channel).filter(F.col("video_id") == newest.scalar())
    return rows.select("comment_id", "video_id", "title", "author_name", "text", "like_count", "published_at", "is_reply")


def best_and_worst_sentiment(gold: DataFrame, channel: str | None = None) -> DataFrame:
    """One row: the videos with the highest and the lowest score (ties: lowest and highest id)."""
    scored = for_channel(gold, channel).filter(F.col("sentiment_score").isNotNull())
    row = F.struct("sentiment_score", "video_id", "title")
    by_score_then_first_id = F.struct(-F.col("sentiment_score"), F.col("video_id"), F.col("title"))
    ends = scored.agg(F.min_by(row, by_score_then_first_id).alias("best"), F.min(row).alias("worst"))
    return ends.select(
        F.col("best.video_id").alias("best_video"), F.col("best.sentiment_score").alias("best_score"),
        F.col("worst.video_id").alias("worst_video"), F.col("worst.sentiment_score").alias("worst_score"),
    )


def comments_with_label(scored: DataFrame, label: str, channel: str | None = None) -> DataFrame:
    rows = for_channel(scored, channel).filter(F.col("sentiment") == label)
    return rows.select("comment_id", "channel_handle", "title", "video_url", "author_name", "text", "like_count")


def compare_channels(kpis: DataFrame) -> DataFrame:
    """Channel totals with ranks by sentiment and by volume.

    A mean score has at most 2,001 values, which make one slice; volumes are sliced by eighths of a
    power of two, at most 512.
    """
    kpis = materialise(kpis, "kpis")  # the ranks look at the few rows several times
    by_score = rank_descending(kpis, "avg_sentiment", F.lit(0), "sentiment_rank")
    eighths = -F.floor(F.log2(F.greatest(F.col("total_comments"), F.lit(1))) * 8)
    return rank_descending(by_score, "total_comments", eighths, "volume_rank")


def reply_coverage(silver: DataFrame, channel: str | None = None) -> DataFrame:
    """Replies the API announced and replies landed, per video.

    Both are sums per video: announced counts stand on top-level rows, landed replies are rows of
    their own, so no join of replies to parents is needed.
    """
    announced = F.sum(F.when(~F.col("is_reply"), F.coalesce("reply_count", F.lit(0))).otherwise(0))
    counts = for_channel(silver, channel).groupBy("video_id").agg(
        announced.alias("announced_replies"), F.count_if("is_reply").alias("landed_replies")
    )
    ratio = F.col("landed_replies").cast("decimal(20,0)") / F.nullif(F.col("announced_replies"), F.lit(0)).cast("decimal(20,0)")
    return counts.withColumn("coverage", F.round(ratio, 4).cast("double"))


def sentiment_trend(scored: DataFrame, unit: str = "day", rows: int = 7, channel: str | None = None) -> DataFrame:
    """Score per channel and period with a moving mean over the last ``rows`` periods that have data."""
    label = F.col("sentiment")
    per_period = (
        for_channel(scored, channel).filter(~F.col("is_reply"))
        .groupBy("channel_handle", F.date_trunc(unit, "published_at").alias("period"))
        .agg(
            F.count(F.lit(1)).alias("comments"),
            (F.count_if(label == "positive") - F.count_if(label == "negative")).alias("_net"),
        )
    )
    ratio = F.col("_net").cast("decimal(20,0)") / F.col("comments").cast("decimal(20,0)")
    recent = Window.partitionBy("channel_handle").orderBy("period").rowsBetween(1 - rows, 0)
    scores = per_period.withColumn("score", F.round(ratio, 3).cast("decimal(15,3)"))
    return scores.select(
        "channel_handle", "period", "comments", "score", F.round(F.avg("score").over(recent), 3).alias("moving_score")
    )


def reply_rate(gold: DataFrame, channel: str | None = None) -> DataFrame:
    ratio = F.col("total_replies").cast("decimal(20,0)") / F.nullif(F.col("total_comments"), F.lit(0)).cast("decimal(20,0)")
    return for_channel(gold, channel).select(
        "video_id", "channel_handle", "title", "total_replies", "total_comments",
        F.round(ratio, 3).cast("double").alias("reply_rate"),
    )
