"""From landed API pages to flat comment and video rows, with limits, batches and run outcomes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chorale import schemas
from chorale.functions.text import video_url
from chorale.operators.positions import running_position
from chorale.session import materialise

# Fixed value: ids per details request, hence records per landed video file.
VIDEO_BATCH_SIZE = 50
# Error texts that mean "comments are switched off" and so count as skipped.
DISABLED_EXACT = "commentsDisabled"
DISABLED_ANY_CASE = "disabled comments"


def newest_landing(pages: DataFrame) -> DataFrame:
    """One landing of each ``(video_id, page_no)``: the last by ``ingested_at``, ties by a hash of the page.

    Landings are compared as narrow rows (a hash stands for the text).  Pages that were landed once pass
    unchanged; only the others are matched, and equal landings of one page are combined.
    """
    return _newest_of(pages, landings(pages))


PAGE_KEY = ["video_id", "page_no"]


def _version() -> Column:
    return F.struct(F.coalesce("ingested_at", F.lit("")).alias("at"), F.xxhash64("raw_json").alias("page"))


def landings(pages: DataFrame, *more: Column) -> DataFrame:
    """One narrow row per page: its ``_newest`` landing, with what ``more`` says of it, how many are equal to that (``_same``) and
    how many there are (``_n``)."""
    names = [f"_more{i}" for i in range(len(more))]
    rows = pages.select(*PAGE_KEY, _version().alias("_newest"), *[c.alias(n) for c, n in zip(more, names)])
    each = rows.groupBy(*PAGE_KEY, "_newest").agg(F.count(F.lit(1)).alias("_same"), *[F.max(n).alias(n) for n in names])
    last = F.max(F.struct("_newest", "_same", *names)).alias("_l")
    return each.groupBy(*PAGE_KEY).agg(last, F.sum("_same").alias("_n")).select(*PAGE_KEY, "_l.*", "_n")


def _newest_of(pages: DataFrame, landed: DataFrame) -> DataFrame:
    """Of these pages the newest landings.  Texts move only where equal landings of a page are combined."""
    many = materialise(landed.filter("_n > 1").select(F.col("video_id").alias("_v"), F.col("page_no").alias("_p"), "_newest", "_same"), "relanded")
    if many.isEmpty():
        return pages
    same = F.col("video_id").eqNullSafe(F.col("_v")) & F.col("page_no").eqNullSafe(F.col("_p"))
    newest = pages.join(many, same, "left").filter(F.col("_newest").isNull() | (_version() == F.col("_newest")))
    if many.filter("_same > 1").isEmpty():
        return newest.select(*pages.columns)
    once = newest.filter("coalesce(_same, 1) = 1").select(*pages.columns)
    return once.unionByName(newest.filter("_same > 1").select(*pages.columns).dropDuplicates(PAGE_KEY))


def page_error(raw_json: Column) -> Column:
    """Why a landed page has no comments to give: the message of an API error, or that it cannot be read; else NULL."""
    read = F.from_json(raw_json, schemas.THREAD_PAGE_JSON[:-1] + ", _bad: string>",
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    told = F.coalesce(F.get_json_object(raw_json, "$.error.errors[0].reason"), F.get_json_object(raw_json, "$.error.message"))
    return F.when(read.isNull() | read["_bad"].isNotNull(), "malformed page").otherwise(told)


def parse_landed_pages(pages: DataFrame, distinct: bool = True) -> DataFrame:
    """Landed pages parsed once, whether they can be read or not, one row for each different landing of these pages:
    ``landed_at`` and ``page_hash`` (which landing it is), ``error`` (as ``page_error``) with the text of such a page,
    ``n`` comments and the comments themselves.  Row-local but for the removal of equal landings; not ``distinct``, there is a row for
    every landing and no text is shuffled.
    """
    read = F.from_json("raw_json", schemas.THREAD_PAGE_JSON[:-1] + ", _bad: string>",
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    told = F.when(F.contains("raw_json", F.lit('"error"')), F.coalesce(
        F.get_json_object("raw_json", "$.error.errors[0].reason"), F.get_json_object("raw_json", "$.error.message")))
    landed_at = F.coalesce("ingested_at", F.lit("")).alias("landed_at")
    once = pages.withColumn("page_hash", F.xxhash64("raw_json"))
    if distinct:
        once = once.dropDuplicates(["video_id", "page_no", "ingested_at", "page_hash"])
    parsed = once.select("video_id", "channel_handle", "page_no", "ingested_at", landed_at, "page_hash", "raw_json", read.alias("_page"))
    bad = F.col("_page").isNull() | F.col("_page._bad").isNotNull()
    judged = parsed.withColumn("error", F.when(bad, "malformed page").otherwise(told))
    comments = F.when(F.col("error").isNull(), F.flatten(F.transform("_page.items", _thread))).cast(schemas.PAGE_COMMENTS)
    return judged.withColumn("comments", comments).select(
        "video_id", "channel_handle", "page_no", "ingested_at", "landed_at", "page_hash", "error",
        F.when(F.col("error").isNotNull(), F.col("raw_json")).alias("bad_json"),
        F.greatest(F.coalesce(F.size("comments"), F.lit(0)), F.lit(0)).cast("bigint").alias("n"), "comments")


def parse_pages(pages: DataFrame, json_type: str = schemas.THREAD_PAGE_JSON) -> DataFrame:
    """Parse ``raw_json`` into ``page``; malformed text stops the job instead of losing a page."""
    parsed = F.from_json("raw_json", json_type, {"mode": "FAILFAST"})
    return pages.withColumn("page", parsed).drop("raw_json")


def _count(c: Column) -> Column:
    return F.coalesce(c.cast("bigint"), F.lit(0).cast("bigint"))


def _comment(comment_id: Column, body: Column, replies: Column, parent: Column, item_pos: Column, reply_pos: Column) -> Column:
    return F.struct(
        comment_id.alias("comment_id"),
        body["authorDisplayName"].alias("author_name"),
        body["textOriginal"].alias("text"),
        _count(body["likeCount"]).alias("like_count"),
        replies.cast("int").alias("reply_count"),
        body["publishedAt"].alias("published_at"),
        parent.cast("string").alias("parent_id"),
        item_pos.cast("int").alias("item_pos"),
        reply_pos.cast("int").alias("reply_pos"),
    )


def _thread(item: Column, item_pos: Column) -> Column:
    """A thread as an array: the top-level comment, then its inline replies."""
    snippet = item["snippet"]
    replies = _count(snippet["totalReplyCount"])
    top = _comment(item["id"], snippet["topLevelComment"]["snippet"], replies, F.lit(None), item_pos, F.lit(0))
    inline = F.coalesce(item["replies"]["comments"], F.array().cast(schemas.REPLY_LIST))
    return F.concat(
        F.array(top),
        F.transform(inline, lambda r, i: _comment(r["id"], r["snippet"], F.lit(0), item["id"], item_pos, i + 1)),
    )


def flatten_threads(pages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per top-level comment and per inline reply, each parent before its replies.

    Input: landed pages (``video_id, channel_handle, page_no, raw_json``).  The place of a row in the
    response is kept as ``landing`` (which response), ``page_no, page_pos`` (and ``item_pos, reply_pos`` for the thread and the reply
    in it, 0 for the top-level comment), because caps and documents depend on it and rows have no order
    of their own.  Columns to ``keep`` come last.  Purely row-local: no shuffle.
    """
    rows = F.flatten(F.transform("page.items", _thread))
    landing = F.concat_ws(":", F.coalesce("ingested_at", F.lit("")), F.hex(F.xxhash64("raw_json")))
    return parse_pages(pages.withColumn("landing", landing)).select(
        "video_id", "channel_handle", "landing", "page_no", *keep, F.posexplode(rows).alias("page_pos", "c")
    ).select(
        "c.comment_id", "video_id", "channel_handle", "c.author_name", "c.text", "c.like_count", "c.reply_count",
        "c.published_at", (F.col("c.reply_pos") > 0).alias("is_reply"), "c.parent_id",
        "page_no", "page_pos", "c.item_pos", "c.reply_pos", "landing", *keep,
    )


def page_sizes(pages: DataFrame) -> DataFrame:
    """The ``landings`` of pages with ``n``, the comments of the newest (top-level plus inline replies), without producing them.

    One pass makes narrow rows of the pages.  Malformed text stops the job if it is the newest landing of its page.
    """
    read = F.from_json("raw_json", schemas.THREAD_PAGE_SIZES_JSON[:-1] + ", _bad: string>",
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    per_item = lambda i: F.lit(1) + F.coalesce(F.array_size(i["replies"]["comments"]), F.lit(0))
    n = F.aggregate(F.transform(F.col("_page.items"), per_item), F.lit(0), lambda a, x: a + x)
    parsed = pages.withColumn("_page", read)
    sizes = landings(parsed, F.coalesce(n, F.lit(0)).cast("bigint"), F.col("_page._bad").isNotNull())
    told = F.concat_ws(" ", F.lit("MALFORMED_RECORD_IN_PARSING: page"), F.col("page_no").cast("string"), F.lit("of"), "video_id")
    n = F.when(F.col("_more1"), F.raise_error(told).cast("bigint")).otherwise(F.col("_more0"))
    return sizes.withColumn("n", n).drop("_more0", "_more1")


def page_cuts(sizes: DataFrame, limit: int, pages_per_slice: int = 1000) -> DataFrame:
    """``video_id, _last_page, _room``: the page of each video that holds its ``limit``-th comment, and how many of that
    page come before the cut.  ``sizes``: ``video_id, page_no, n``, one narrow row per page; videos below the limit have no row."""
    sizes = sizes.withColumn("_slice", F.floor(F.col("page_no") / pages_per_slice))
    slices = sizes.groupBy("video_id", "_slice").agg(F.sum("n").alias("_n"))
    rows_to_here = lambda w: w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before_slice = F.sum("_n").over(rows_to_here(Window.partitionBy("video_id").orderBy("_slice"))) - F.col("_n")
    # Only the slice in which the limit is reached needs its pages looked at one by one.
    reached = slices.withColumn("_before", before_slice).filter(
        (F.col("_before") < limit) & (F.col("_before") + F.col("_n") >= limit)
    ).select("video_id", "_slice", "_before")
    seen = F.col("_before") + F.sum("n").over(
        rows_to_here(Window.partitionBy("video_id", "_slice").orderBy("page_no")))
    return (
        sizes.join(reached, ["video_id", "_slice"])
        .select("video_id", "page_no", seen.alias("_seen"), (seen - F.col("n")).alias("_start"))
        .filter((F.col("_start") < limit) & (F.col("_seen") >= limit))
        .select("video_id", F.col("page_no").alias("_last_page"), (limit - F.col("_start")).alias("_room"))
    )


def before_cut() -> Column:
    """Whether a comment of a video with a cut (see ``page_cuts``) comes before it; true for the others."""
    last = F.col("_last_page")
    return last.isNull() | (F.col("page_no") < last) | ((F.col("page_no") == last) & (F.col("page_pos") < F.col("_room")))


def limit_comments(pages: DataFrame, limit: int, pages_per_slice: int = 1000) -> DataFrame:
    """Flattened comments, at most the first ``limit`` per video (0 = all), replies counted.

    Of a page that was landed several times the newest landing counts.

    The cut is found on page sizes alone: one narrow row per page, summed per slice of pages and then
    per video, so neither texts nor a hot video's pages meet in one task.  Whole pages before the cut
    are kept, later ones dropped, and only the page holding the cut is trimmed, which can end a thread
    between two replies.  The cuts (one row per video over the limit) are written out first, so the
    comments are not shuffled for them unless there are too many to broadcast.
    """
    if limit <= 0:
        return flatten_threads(newest_landing(pages))
    sizes = materialise(page_sizes(pages), "page-sizes")
    cuts = materialise(page_cuts(sizes.select(*PAGE_KEY, "n"), limit, pages_per_slice), "cuts")
    up_to_cut = lambda rows: rows.join(cuts, "video_id", "left").filter(
        F.col("_last_page").isNull() | (F.col("page_no") <= F.col("_last_page"))).select(*rows.columns)
    newest = _newest_of(up_to_cut(pages), up_to_cut(sizes))
    return flatten_threads(newest).join(cuts, "video_id", "left").filter(before_cut()).drop("_last_page", "_room")


def flatten_video_ids(pages: DataFrame) -> DataFrame:
    """Playlist pages to video ids with their place in the newest-first list."""
    return parse_pages(pages, schemas.VIDEO_ID_PAGE_JSON).select(
        "channel_handle", "page_no", F.posexplode("page.items").alias("item_pos", "item")
    ).select("channel_handle", "page_no", "item_pos", F.col("item.contentDetails.videoId").alias("video_id"))


def video_records(pages: DataFrame) -> DataFrame:
    """Video detail pages to landed records: one row per item, the whole item as JSON text.

    Input: ``channel_handle, channel_id, channel_name, raw_json``.  Items are variants, so fields this
    library does not know survive.
    """
    items = parse_pages(pages, schemas.VIDEO_ITEM_PAGE_JSON).select(
        "channel_handle", "channel_id", "channel_name", F.explode("page.items").alias("item")
    )
    return items.select(
        F.variant_get("item", "$.id", "string").alias("video_id"),
        "channel_handle", "channel_id", "channel_name",
        F.to_json("item").alias("raw_json"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("ingested_at"),
    )


def video_list(records: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Landed video records to ``video_id, channel_handle, title, published_at, video_url`` (and the columns to ``keep``)."""
    raw = F.from_json("raw_json", schemas.VIDEO_ITEM_JSON, {"mode": "FAILFAST"})
    return records.select("video_id", "channel_handle", raw.alias("raw"), *(keep or [])).select(
        "video_id",
        "channel_handle",
        F.col("raw.snippet.title").alias("title"),
        F.col("raw.snippet.publishedAt").alias("published_at"),
        video_url(F.col("video_id")).alias("video_url"),
        *(keep or []),
    )


def _newest_first() -> list[Column]:
    """Newest first; equal times in the order of a hash of the id, which is the same on every run."""
    return [F.col("published_at").desc_nulls_last(), F.md5("video_id").asc(), F.col("video_id").asc()]


def newest_videos(videos: DataFrame, limit: int, per_channel: bool = True) -> DataFrame:
    """The newest ``limit`` videos (0 = all), per channel or overall."""
    newest = _newest_first()
    if limit <= 0:
        return videos
    if not per_channel:
        return videos.orderBy(*newest).limit(limit)
    rank = F.row_number().over(Window.partitionBy("channel_handle").orderBy(*newest))
    return videos.withColumn("_rn", rank).filter(F.col("_rn") <= limit).drop("_rn")


FILE_ORDER = ["file_path", "block_start", "line_in_block"]


def first_videos(records: DataFrame, limit: int, per_channel: bool = True) -> DataFrame:
    """The first ``limit`` videos (0 = all) in the order of the landed files, per channel or overall, as ``video_list`` rows.

    ``records`` come from ``read_video_records_in_order``.  A video that landed several times counts at its first place.
    """
    listed = video_list(records.filter("video_id IS NOT NULL"), FILE_ORDER)
    first = F.min(F.struct(*FILE_ORDER, *[c for c in listed.columns if c not in ("video_id", *FILE_ORDER)])).alias("v")
    once = listed.groupBy("video_id").agg(first).select("video_id", "v.*")
    if limit > 0 and per_channel:
        rank = F.row_number().over(Window.partitionBy("channel_handle").orderBy(*FILE_ORDER))
        once = once.withColumn("_rn", rank).filter(F.col("_rn") <= limit).drop("_rn")
    elif limit > 0:
        once = once.orderBy(*FILE_ORDER).limit(limit)
    return once.drop(*FILE_ORDER)


def batch_videos(videos: DataFrame, size: int = VIDEO_BATCH_SIZE) -> DataFrame:
    """Add ``batch`` (``batch_0001`` ...): chunks of ``size`` videos per channel, newest first.

    A video has one record (see ``one_row_per_video``).  Positions are counted by hour of publication, then by time and the first byte of the id's hash, so
    neither a channel with a third of all videos nor an instant with that many is numbered by one task.
    """
    # Complemented digits rise as the time falls; '~' puts missing times last.
    falling = F.coalesce(F.translate("published_at", "0123456789", "9876543210"), F.lit("~"))
    fine = F.concat(falling, F.lit("|"), F.substring(F.md5("video_id"), 1, 2))
    slices = [F.substring(falling, 1, 13), fine]
    # The keys are written once and numbered alone; the records, however they are made, meet them in one join.
    keys = materialise(videos.select("video_id", "channel_handle", "published_at"), "batch-keys")
    positions = running_position(keys, ["channel_handle"], slices, _newest_first(), "_position")
    number = (F.floor((F.col("_position") - 1) / size) + 1).cast("string")
    padded = F.when(F.length(number) < 4, F.lpad(number, 4, "0")).otherwise(number)
    batches = positions.select(
        F.col("video_id").alias("_v"), F.col("channel_handle").alias("_c"), F.col("published_at").alias("_p"),
        F.concat(F.lit("batch_"), padded).alias("batch"))
    same = [F.col(a).eqNullSafe(F.col(b)) for a, b in (("video_id", "_v"), ("channel_handle", "_c"), ("published_at", "_p"))]
    return videos.join(batches, same).drop("_v", "_c", "_p")


def outcome_status(error: Column, n_comments: Column) -> Column:
    """fetched, skipped (comments disabled or none found) or error, per video."""
    disabled = error.contains(DISABLED_EXACT) | F.lower(error).contains(DISABLED_ANY_CASE)
    return (
        F.when(disabled, "skipped")
        .when(error.isNotNull(), "error")
        .when(F.coalesce(n_comments, F.lit(0)) == 0, "skipped")
        .otherwise("fetched")
    )


def ingest_outcomes(runs: DataFrame) -> DataFrame:
    """Videos per status from ``(error, n_comments)`` rows."""
    return runs.groupBy(outcome_status(F.col("error"), F.col("n_comments")).alias("status")).agg(
        F.count(F.lit(1)).alias("videos")
    )
