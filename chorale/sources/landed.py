"""Batch readers of landed files and tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chorale import schemas


#: Landed files, plain or compressed.
LANDED = "*.{json,json.gz}"


def _read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """NDJSON files ending in ``.json`` or ``.json.gz`` at any depth; directory names are no columns, blank lines no rows."""
    reader = spark.read.schema(schema).option("pathGlobFilter", LANDED).option("recursiveFileLookup", "true")
    try:
        return reader.json(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no landed files at {path}: run the ingestion first") from e
        raise


def read_comment_records(spark: SparkSession, path: str) -> DataFrame:
    """Landed comment records with the time of reading, as the raw table holds them."""
    return _read_json(spark, path, schemas.COMMENT_RECORD).withColumn("_ingested_at", F.current_timestamp())


def read_video_records(spark: SparkSession, path: str) -> DataFrame:
    return _read_json(spark, path, schemas.VIDEO_RECORD)


def read_video_records_in_order(spark: SparkSession, path: str) -> DataFrame:
    """Video records with ``file_path``, ``block_start`` and ``line_in_block``: their place in the landed files, which a
    plain reading of the files in the order of their names has as well.

    A split of a file begins at a byte and is read by one task in order, so (file, split, number in the task) orders all lines
    without a sort; only the rows that a limit keeps are ever compared.
    """
    lines = _read_json(spark, path, schemas.VIDEO_RECORD)
    return lines.select("*", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("block_start"),
                        F.monotonically_increasing_id().alias("line_in_block"))


def read_thread_pages(spark: SparkSession, path: str) -> DataFrame:
    return _read_json(spark, path, schemas.THREAD_PAGE_RECORD)


def count_files(spark: SparkSession, path: str, suffix: str = ".json") -> DataFrame:
    """``path, files``: files below ``path`` with the suffix, compressed or not (contents are not read); 0 for a missing path."""
    one = spark.range(1).select(F.lit(path).alias("path"))
    try:
        files = (
            spark.read.format("binaryFile").option("pathGlobFilter", f"*{{{suffix},{suffix}.gz}}")
            .option("recursiveFileLookup", "true").load(path).select("path")
        )
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return one.withColumn("files", F.lit(0).cast("bigint"))
        raise
    return files.agg(F.count(F.lit(1)).alias("files")).select(F.lit(path).alias("path"), "files")
