"""Channel lookups and the channel filter every answer can take."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chorale import schemas

CHANNEL_BUCKETS = 64


def for_channel(df: DataFrame, channel: str | None) -> DataFrame:
    """Rows of one channel.  Tables that are laid out by ``channel_bucket`` are pruned to its directory."""
    if channel is None:
        return df
    rows = df.filter(F.col("channel_handle") == channel)
    return rows.filter(F.col("channel_bucket") == channel_bucket(F.lit(channel))) if "channel_bucket" in df.columns else rows


def channel_bucket(handle: Column) -> Column:
    """Directory of a channel in the raw and cleaned tables.  A hot channel's directory holds as many files as were written."""
    return F.pmod(F.xxhash64(F.coalesce(handle, F.lit(""))), F.lit(CHANNEL_BUCKETS)).cast("int")


def channel_info(pages: DataFrame) -> DataFrame:
    """Channel lookups (``channel_handle, raw_json``) to id, display name and uploads list.

    The first item of a response is the channel; a response without items stops the job.
    """
    page = F.from_json("raw_json", schemas.CHANNEL_PAGE_JSON, {"mode": "FAILFAST"})
    missing = F.raise_error(F.concat(F.lit("no channel found for handle "), F.coalesce("channel_handle", F.lit("NULL"))))
    found = pages.select("channel_handle", F.get(page["items"], 0).alias("item")).withColumn(
        "item", F.when(F.col("item").isNotNull(), F.col("item")).otherwise(missing.cast(schemas.CHANNEL_ITEM_JSON))
    )
    return found.select(
        "channel_handle", F.col("item.id").alias("channel_id"), F.col("item.snippet.title").alias("channel_name"),
        F.col("item.contentDetails.relatedPlaylists.uploads").alias("uploads_playlist_id"),
    )
