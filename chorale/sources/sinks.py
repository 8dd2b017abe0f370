"""Batch writers.  Each run writes a directory of its own, so file streams see new paths, not changed ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chorale.functions.text import channel_slug
from chorale.operators.documents import LINE_ORDER, document_name
from chorale.operators.landing import batch_videos
from chorale.schemas import COMMENT_FIELDS
from chorale.sources.named_files import write_named_text

ROWS_PER_FILE = 1_000_000
#: A compressed file is read by one task, so it holds less: rows with a text each, and pages of 100 threads.
ROWS_PER_PACKED_FILE, PAGES_PER_FILE = 100_000, 500
ID_SPREAD = 64


def write_comment_files(comments: DataFrame, run_dir: str, spread: Column | None = None, files: int = 1) -> None:
    """Comment records as compressed NDJSON files of bounded size: what the raw stream reads.

    The tasks that have the rows write them, so texts are not shuffled for it.  With ``spread``, rows are dealt by it to
    ``files`` tasks, whatever their video: what stands near each other there shares a file.
    """
    rows, _ = _records(comments, spread)
    dealt = rows if spread is None else rows.repartition(files, spread)
    dealt.select(*COMMENT_FIELDS).write.mode("overwrite").option("ignoreNullFields", "false").option(
        "maxRecordsPerFile", ROWS_PER_PACKED_FILE).json(run_dir, compression="gzip")


def _records(comments: DataFrame, spread: Column | None) -> tuple[DataFrame, list[Column]]:
    """Rows with their stamp, and the keys that deal them out.  Without a page, rows are spread by their id."""
    if spread is None:
        spread = F.floor(F.col("page_no") / 100) if "page_no" in comments.columns else F.pmod(F.xxhash64("comment_id", "text"), F.lit(ID_SPREAD))
    if "ingested_at" not in comments.columns:
        stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
        comments = comments.withColumn("ingested_at", stamp)
    return comments, [F.col("video_id"), spread]


def write_comment_records(
    comments: DataFrame, run_dir: str, spread: Column | None = None, compression: str | None = None, dealt: bool = False
) -> None:
    """Comment records as NDJSON in one directory per video, an export; NULLs are written out.

    ``spread`` (by default the page of the comment, else its id) divides the rows of a video over tasks,
    so a hot video becomes several files in its directory instead of one slow task.  ``compression``: say ``gzip``.
    ``dealt``: the tasks that have the rows write them, a file per task and video, and no text is shuffled.
    """
    comments, keys = _records(comments, spread)
    rows = (comments if dealt else comments.repartition(*keys)).select(*COMMENT_FIELDS, F.col("video_id").alias("video_dir"))
    (
        rows.write.partitionBy("video_dir").option("ignoreNullFields", "false")
        .option("maxRecordsPerFile", ROWS_PER_PACKED_FILE if compression else ROWS_PER_FILE).json(run_dir, compression=compression)
    )


def write_thread_pages(pages: DataFrame, run_dir: str) -> None:
    """Landed comment pages as compressed NDJSON, by the tasks that have them: texts are not shuffled for it."""
    pages.write.option("maxRecordsPerFile", PAGES_PER_FILE).json(run_dir, compression="gzip")


def write_video_batches(records: DataFrame, run_dir: str) -> None:
    """Video records in one file per channel and batch of 50, newest first (needs ``published_at``)."""
    batched = batch_videos(records).withColumn("channel_slug", channel_slug(F.col("channel_handle")))
    (
        batched.drop("published_at").repartition("channel_slug", "batch")
        .write.partitionBy("channel_slug", "batch").option("ignoreNullFields", "false").json(run_dir)
    )


def write_documents(parts: DataFrame, run_dir: str, compression: str | None = None) -> None:
    """Document parts as text below ``channel_slug=.../file_name=.../part=.../``, one file each, by the tasks that made them."""
    rows = parts.select("channel_slug", "file_name", "part", "body")
    rows.write.mode("overwrite").partitionBy("channel_slug", "file_name", "part").option("lineSep", "\n").text(run_dir, compression=compression)


def write_document_files(parts: DataFrame, path: str) -> None:
    """Documents as ``<channel>/<video>_<title>.txt``, each replaced as a whole; other files below ``path`` stay."""
    file = F.concat_ws("/", "channel_slug", "file_name")
    write_named_text(parts.select(file.alias("file"), "part", "body"), path, ["part"])


def write_document_lines(lines: DataFrame, path: str, packed: bool = False) -> None:
    """The same files from ``document_lines``: texts are shuffled once, as packed pages, as no parts are made.  ``packed``: gzip, ``.txt.gz``."""
    name = document_name(F.col("video_id"), F.col("title"))
    file = F.concat_ws("/", channel_slug(F.col("channel_handle")), F.concat(name, F.lit(".gz" if packed else "")))
    order = ["video_id", "channel_handle", "title", *LINE_ORDER[:-1], "body"]
    write_named_text(lines.withColumnRenamed("line", "body").withColumn("file", file), path, order, page=len(order) - 2)


def write_comment_file_per_video(comments: DataFrame, path: str, packed: bool = False) -> None:
    """Comment records as ``<video>.json``, a line each, in the order of the pages; NULLs are written out.  ``packed``: gzip, ``.json.gz``."""
    rows, _ = _records(comments, None)
    paged = "page_no" in comments.columns
    order = ["page_no", "page_pos"] if paged else ["published_at", "comment_id"]
    line = F.to_json(F.struct(*COMMENT_FIELDS), {"ignoreNullFields": "false"})
    file = F.concat("video_id", F.lit(".json.gz" if packed else ".json"))
    write_named_text(rows.select(file.alias("file"), *order, line.alias("body")), path, order, page=1 if paged else None)


def write_batch_files(records: DataFrame, path: str) -> None:
    """Video records as ``<channel>/batch_0001.json`` ..., 50 lines each, newest first (needs ``published_at``)."""
    batched = batch_videos(records)
    file = F.concat(channel_slug(F.col("channel_handle")), F.lit("/"), F.col("batch"), F.lit(".json"))
    kept = [c for c in records.columns if c != "published_at"]
    line = F.to_json(F.struct(*kept), {"ignoreNullFields": "false"})
    falling = F.coalesce(F.translate("published_at", "0123456789", "9876543210"), F.lit("~")).alias("falling")
    rows = batched.select(file.alias("file"), falling, F.md5("video_id").alias("tie"), line.alias("body"))
    write_named_text(rows, path, ["falling", "tie", "body"])


def write_clustered(df: DataFrame, path: str, keys: list[str], spread: str, mode: str = "overwrite") -> None:
    """Parquet laid out by ``keys``: range-partitioned and sorted, so min/max statistics skip files.

    ``spread`` is the last range column; it splits a key that holds more rows than one file should.
    """
    (
        df.repartitionByRange(*keys, spread).sortWithinPartitions(*keys, spread)
        .write.mode(mode).option("maxRecordsPerFile", ROWS_PER_FILE).parquet(path)
    )


# Schema names of the landing area and the three layers.
LAYERS = ("bronze", "silver", "gold", "landing")


def create_schemas(spark: SparkSession, location: str, prefix: str = "yt") -> DataFrame:
    """Create the layer schemas ``<prefix>_<layer>`` where they do not exist yet and list them; nothing is replaced."""
    for layer in LAYERS:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {prefix}_{layer} LOCATION '{location}/{prefix}_{layer}'")
    return spark.sql(f"SHOW SCHEMAS LIKE '{prefix}_*'")
