"""Cleaned, typed comments (used unchanged on batch and streaming frames)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorale.functions.time import iso_timestamp
from chorale.session import materialise


def clean_comments(raw: DataFrame, on_bad_timestamp: str = "raise") -> DataFrame:
    """Typed projection of the raw rows without blank texts.

    Trimming removes spaces only, so a text of one line break stays.  NULL ids stay as well: the
    expectation on them warns, it does not drop.
    """
    return raw.select(
        "comment_id",
        "video_id",
        F.col("video_title").alias("title"),
        "video_url",
        "channel_handle",
        "author_name",
        F.trim("text").alias("text"),
        "like_count",
        "reply_count",
        iso_timestamp(F.col("published_at"), on_bad_timestamp).alias("published_at"),
        "is_reply",
        "parent_id",
        F.col("_ingested_at").alias("processed_at"),
    ).filter(F.length("text") > 0)


def latest_per_comment(raw: DataFrame, version: str = "ingested_at") -> DataFrame:
    """Opt-in: keep the row with the highest ``version`` of each ``comment_id``; rows without id stay.

    Repeated ids are found first, on the id column alone, and written out.  All other rows then pass
    without a shuffle (as long as the repeated ids can be broadcast), and only copies are compared: by an
    aggregate that combines them map-side, so an id with very many copies costs one row per task.  Ties
    go to the greatest row, which makes reruns repeatable.

    Copies are compared without their texts, for which a digest stands; the newest of each id is written, and finds its text again:
    what is shuffled are the different texts, combined map-side, and not one per landing.
    """
    ids = raw.select("comment_id").filter(F.col("comment_id").isNotNull())
    many = ids.groupBy("comment_id").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    repeated = materialise(many.select("comment_id"), "repeated")
    copies = raw.join(repeated, "comment_id", "left_semi")
    newest = _newest_by_digest(copies, version) if "text" in raw.columns else _newest_row(copies, version)
    return raw.join(repeated, "comment_id", "left_anti").select(*raw.columns).unionByName(newest.select(*raw.columns))


def _newest_row(copies: DataFrame, version: str) -> DataFrame:
    rest = [c for c in copies.columns if c not in ("comment_id", version)]
    best = copies.groupBy("comment_id").agg(F.max(F.struct(version, *rest)).alias("_r"))
    return best.select("comment_id", *[F.col(f"_r.{c}").alias(c) for c in (version, *rest)])


def _newest_by_digest(copies: DataFrame, version: str) -> DataFrame:
    """``_newest_row`` with the texts apart.  Digests have another order than texts: of the rows that are equal up to the text, those with the
    greatest and with the least digest are kept, and where these differ the texts themselves are compared."""
    rest = [c for c in copies.columns if c not in ("comment_id", version)]
    at = rest.index("text")
    digest = F.sha2("text", 256)
    falling = F.translate(digest, "0123456789abcdef", "fedcba9876543210")
    lead = [F.col(version).alias(version), *[F.col(c) for c in rest[:at]]]
    best = copies.groupBy("comment_id").agg(
        F.max(F.struct(*lead, digest.alias("_text"), *rest[at + 1:])).alias("_r"),
        F.max(F.struct(*lead, falling.alias("_least"))).alias("_l"))
    one = F.translate("_l._least", "fedcba9876543210", "0123456789abcdef").eqNullSafe(F.col("_r._text"))
    names = [version, *rest[:at], "_text", *rest[at + 1:]]
    best = materialise(best.select("comment_id", one.alias("_one"), *[F.col(f"_r.{c}").alias(c) for c in names]), "newest")
    texts = copies.filter(F.col("text").isNotNull()).select("text").distinct().select(F.sha2("text", 256).alias("_text"), "text")
    newest = best.filter("_one").join(texts, "_text", "left").select(*copies.columns)
    torn = best.filter("NOT _one").select("comment_id")
    if torn.isEmpty():
        return newest
    return newest.unionByName(_newest_row(copies.join(torn, "comment_id", "left_semi"), version).select(*copies.columns))
