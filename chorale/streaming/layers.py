"""The raw, cleaned and scored tables as file streams, and the metrics merged from them.

Every stream is a finite run (``availableNow``) over what is new since the last one; the checkpoint
holds the progress.  All three are stateless and append-only, so a lost executor costs a retried task
and a lost driver a resumed micro-batch, never a row.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chorale import schemas
from chorale.functions.sentiment import Scorer
from chorale.operators.channels import channel_bucket
from chorale.operators.gold import finish_metrics, merge_partials, partial_metrics, score_top_level
from chorale.operators.quality import SILVER_EXPECTATIONS, Expectation, apply_expectations, quarantine
from chorale.operators.silver import clean_comments
from chorale.schemas import GOLD_KEYS
from chorale.session import PACKED, exists, names_in, remove
from chorale.sources.landed import LANDED

SILVER_METRICS = "silver_expectations"
BY_CHANNEL = ", channel_bucket int"
PROGRESS_SECONDS = 5
KEPT_REPORTS = 100_000
KEPT_STATES = 3
#: State of a stream on the disks of the executors, its changes in the checkpoint; the heap holds none of it.
STATE_ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
#: What the metrics need of a scored comment; its text stays in the cleaned table.
SCORED_COLUMNS = ["comment_id", *GOLD_KEYS, "like_count", "reply_count", "published_at", "sentiment"]


def read_comment_stream(
    spark: SparkSession, landing: str, max_files: int | None = None, archive: str | None = None
) -> DataFrame:
    """New ``.json`` (or ``.json.gz``) files at any depth; directory names are not taken for columns.

    The file source lists ``landing`` for every micro-batch.  With ``archive`` (a folder outside of it)
    finished files are moved there, so the listing does not grow with the history.
    """
    reader = (
        spark.readStream.schema(schemas.COMMENT_RECORD)
        .option("recursiveFileLookup", "true").option("pathGlobFilter", LANDED)
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.json(landing).withColumn("_ingested_at", F.current_timestamp())


def read_table_stream(spark: SparkSession, path: str, schema: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def append_available(df: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None) -> list[dict]:
    """Append everything that is available, then stop.  Returns the progress of every micro-batch.

    The query object keeps only its latest reports: as many as one run has, and they are gathered while it runs.
    """
    writer = df.writeStream.format("parquet").options(**PACKED).outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    keep_reports(df.sparkSession)
    return run_to_end(writer.trigger(availableNow=True).start(path))


def keep_reports(spark: SparkSession) -> None:
    """Let a query started from now on keep the reports of all its micro-batches."""
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", str(KEPT_REPORTS))


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the streams started inside; a stream keeps those it was started with."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def run_to_end(query: StreamingQuery) -> list[dict]:
    """Wait until a query has read what is available; gives one report per micro-batch."""
    seen: dict[int, dict] = {}
    finished = False
    while not finished:
        finished = query.awaitTermination(PROGRESS_SECONDS)
        for p in query.recentProgress:
            report = p if isinstance(p, dict) else p.jsonValue
            # A batch can be followed by an idle report under its number; only the first one counts rows.
            seen.setdefault(report["batchId"], report)
    return [seen[b] for b in sorted(seen)]


def run_raw(
    spark: SparkSession, landing: str, raw: str, checkpoint: str, max_files: int | None = None,
    archive: str | None = None,
) -> list[dict]:
    """Raw comments, laid out by channel."""
    rows = read_comment_stream(spark, landing, max_files, archive)
    rows = rows.withColumn("channel_bucket", channel_bucket(F.col("channel_handle")))
    return append_available(rows, raw, checkpoint, ["channel_bucket"])


def run_silver(
    spark: SparkSession,
    raw: str,
    silver: str,
    checkpoint: str,
    on_bad_timestamp: str = "raise",
    expectations: tuple[Expectation, ...] = SILVER_EXPECTATIONS,
    dedup_within: str | None = None,
    max_files: int | None = None,
) -> list[dict]:
    """Cleaned comments, laid out by channel.  ``dedup_within`` (say ``'7 days'``) drops a repeated ``comment_id`` landed
    within that time, in this run or an earlier one; the first one stays.  An id is forgotten when the watermark (on
    ``processed_at``, as far behind the newest row) is that time past it, so the state holds the ids of the last two times
    ``dedup_within`` (``state_rows``), on disk.
    Rows without an id are not duplicates of each other and stay.  A row that lands with a stamp older than the watermark
    is not compared any more and would be lost; ``late_rows`` counts them."""
    cleaned = clean_comments(read_table_stream(spark, raw, schemas.RAW_COMMENTS + BY_CHANNEL, max_files), on_bad_timestamp)
    if dedup_within:
        marked = cleaned.withWatermark("processed_at", dedup_within)
        unique = marked.filter(F.col("comment_id").isNotNull()).dropDuplicatesWithinWatermark(["comment_id"])
        cleaned = unique.unionByName(marked.filter(F.col("comment_id").isNull()))
    checked = apply_expectations(cleaned, expectations, SILVER_METRICS)
    placed = checked.withColumn("channel_bucket", channel_bucket(F.col("channel_handle")))
    with settings(spark, STATE_ON_DISK if dedup_within else {}):
        return append_available(placed, silver, checkpoint, ["channel_bucket"])


def _of_state(progress: list[dict], name: str) -> list[int]:
    return [sum(int(s[name]) for s in p.get("stateOperators") or []) for p in progress]


def state_rows(progress: list[dict]) -> list[int]:
    """Ids in the state after each micro-batch."""
    return _of_state(progress, "numRowsTotal")


def late_rows(progress: list[dict]) -> int:
    """Rows that came behind the watermark."""
    return sum(_of_state(progress, "numRowsDroppedByWatermark"))


def run_silver_split(
    spark: SparkSession,
    raw: str,
    silver: str,
    quarantined: str,
    checkpoint: str,
    on_bad_timestamp: str = "raise",
    expectations: tuple[Expectation, ...] = SILVER_EXPECTATIONS,
    max_files: int | None = None,
) -> list[dict]:
    """Cleaned comments, and the rows that a ``drop`` expectation takes out of them in a table of their own, with the names of
    the expectations they break (``violated``).

    A micro-batch is written to both tables, each time into the directory of its number: repeated after a failure, it
    replaces what the first attempt has left, so every row is in one of the tables, once.  Counts are reported as by ``run_silver``.
    Tables written this way have no stream log of their own; the next layer reads them as plain files (``read_table_stream``).
    """
    dropping = [e for e in expectations if e.action == "drop"]
    cleaned = clean_comments(read_table_stream(spark, raw, schemas.RAW_COMMENTS + BY_CHANNEL, max_files), on_bad_timestamp)
    watched = apply_expectations(cleaned, [e for e in expectations if e.action != "drop"])
    counted = watched.observe(SILVER_METRICS, F.count(F.lit(1)).alias("rows"), *[F.count_if(~e.holds).alias(e.name) for e in expectations])
    placed = counted.withColumn("channel_bucket", channel_bucket(F.col("channel_handle")))

    def put(batch: DataFrame, number: int) -> None:
        for rows, path in ((apply_expectations(batch, dropping), silver), (quarantine(batch, dropping), quarantined)):
            rows.write.options(**PACKED).mode("overwrite").partitionBy("channel_bucket").parquet(f"{path}/batch={number}")

    keep_reports(spark)
    return run_to_end(placed.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def expectation_counts(progress: list[dict]) -> dict[str, int]:
    """Violations per expectation (and ``rows``), summed over micro-batches."""
    totals: dict[str, int] = {}
    for p in progress:
        metrics = (p.get("observedMetrics") or {}).get(SILVER_METRICS)
        for name, n in (metrics.asDict() if hasattr(metrics, "asDict") else metrics or {}).items():
            totals[name] = totals.get(name, 0) + int(n or 0)
    return totals


def run_scored(
    spark: SparkSession, silver: str, scored: str, checkpoint: str, run_id: int,
    scorer: Scorer | None = None, max_files: int | None = None,
) -> list[dict]:
    """Score each top-level comment once and keep it, in a partition per run."""
    new = read_table_stream(spark, silver, schemas.SILVER_COMMENTS + BY_CHANNEL, max_files)
    rows = score_top_level(new, scorer).select(*SCORED_COLUMNS).withColumn("run_id", F.lit(run_id).cast("bigint"))
    return append_available(rows, scored, checkpoint, ["run_id"])


def committed_runs(spark: SparkSession, path: str, key: str = "run_id") -> list[int]:
    """Runs ``<key>=<n>`` below ``path`` whose job has finished, in order.  Looks at names, reads no table."""
    found = [int(n.split("=")[1]) for n in names_in(spark, path) if n.startswith(f"{key}=")]
    return sorted(n for n in found if exists(spark, f"{path}/{key}={n}/_SUCCESS"))


def _read_scored(spark: SparkSession, path: str) -> DataFrame:
    try:
        df = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise FileNotFoundError(f"no scored comments at {path}") from e
        raise
    if "run_id" not in df.columns:
        raise FileNotFoundError(f"no scored comments at {path}")
    return df


def last_merged_run(spark: SparkSession, state: str) -> int | None:
    """Highest complete run in the state table."""
    return max(committed_runs(spark, state), default=None)


def merge_gold(spark: SparkSession, scored: str, state: str, run_id: int) -> DataFrame:
    """Add the scored runs after the last merged one to the state and return the metrics.

    Only new partitions of ``scored`` are read, so the cost follows the new rows, however large a video
    has become.  The state has one row per video and is written as a new version ``run_id=<run_id>``
    that counts when its job has committed: a failed run leaves the old version, a repeated one
    overwrites its own.  The last ``KEPT_STATES`` versions stay.  Run ids must rise; an id already merged
    is refused unless nothing is new.
    """
    last = last_merged_run(spark, state)
    if last is not None and run_id < last:
        raise ValueError(f"run {run_id} is older than the merged run {last}")
    if last is None or run_id > last:
        new = _read_scored(spark, scored).filter(F.col("run_id") <= run_id)
        if last is not None:
            new = new.filter(F.col("run_id") > last)
        merged = partial_metrics(new)
        if last is not None:
            merged = merge_partials(spark.read.parquet(f"{state}/run_id={last}"), merged)
        merged.write.mode("overwrite").parquet(f"{state}/run_id={run_id}")
        for old in committed_runs(spark, state)[:-KEPT_STATES]:
            remove(spark, f"{state}/run_id={old}")
    return finish_metrics(spark.read.parquet(f"{state}/run_id={run_id}"))
