"""Per-video comment metrics: full, merged from increments, or recomputed for touched videos.

All three share one pair of functions: :func:`partial_metrics` (sums, counts and a maximum, which can be
added up) and :func:`finish_metrics` (the ratios).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorale.functions.sentiment import Scorer, add_sentiment
from chorale.schemas import GOLD_KEYS
from chorale.session import materialise


def score_top_level(silver: DataFrame, scorer: Scorer | None = None) -> DataFrame:
    """Top-level comments with ``sentiment``; rows whose ``is_reply`` is NULL are left out."""
    return add_sentiment(silver.filter(~F.col("is_reply")), scorer)


def partial_metrics(scored: DataFrame) -> DataFrame:
    """Additive part of the metrics per (video, channel, title, url); a re-titled video has two rows."""
    label = F.col("sentiment")
    return scored.groupBy(*GOLD_KEYS).agg(
        F.count(F.lit(1)).alias("total_comments"),
        F.sum("like_count").alias("total_likes"),
        F.count("like_count").alias("_liked"),
        F.sum("reply_count").alias("total_replies"),
        F.count_if(label == "positive").alias("positive_comments"),
        F.count_if(label == "negative").alias("negative_comments"),
        F.count_if(label == "neutral").alias("neutral_comments"),
        F.max("published_at").alias("latest_comment_at"),
    )


def merge_partials(old: DataFrame, new: DataFrame) -> DataFrame:
    """Add up two sets of partial metrics."""
    both = old.unionByName(new)
    sums = [c for c in both.columns if c not in (*GOLD_KEYS, "latest_comment_at")]
    return both.groupBy(*GOLD_KEYS).agg(
        *[F.sum(c).alias(c) for c in sums], F.max("latest_comment_at").alias("latest_comment_at")
    )


def finish_metrics(partials: DataFrame) -> DataFrame:
    """Ratios and the stamp.  The score counts unknown labels in its denominator only."""
    total = F.col("total_comments")
    avg_likes = F.col("total_likes").cast("double") / F.nullif(F.col("_liked"), F.lit(0))
    net = (F.col("positive_comments") - F.col("negative_comments")).cast("decimal(20,0)")
    score = F.round(net / F.nullif(total, F.lit(0)).cast("decimal(20,0)"), 3).cast("decimal(15,3)")
    return partials.select(
        *GOLD_KEYS,
        "total_comments",
        "total_likes",
        F.round(avg_likes, 2).alias("avg_likes_per_comment"),
        "total_replies",
        "positive_comments",
        "negative_comments",
        "neutral_comments",
        score.alias("sentiment_score"),
        "latest_comment_at",
        F.current_timestamp().alias("computed_at"),
    )


def comment_metrics(silver: DataFrame, scorer: Scorer | None = None) -> DataFrame:
    """The whole roll-up.  One shuffle, of one narrow partial row per video and task."""
    return finish_metrics(partial_metrics(score_top_level(silver, scorer)))


def refresh_touched(gold: DataFrame, silver: DataFrame, changed: DataFrame, scorer: Scorer | None = None) -> DataFrame:
    """Gold after a change: videos named in ``changed`` are recomputed, all others kept.

    For corrections of old rows; plain additions are cheaper with :func:`merge_partials`.
    """
    ids = materialise(changed.select("video_id").distinct(), "touched")
    kept = gold.join(ids, "video_id", "left_anti")
    fresh = comment_metrics(silver.join(ids, "video_id", "left_semi"), scorer)
    return kept.select(*fresh.columns).unionByName(fresh)
