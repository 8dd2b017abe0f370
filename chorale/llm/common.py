"""Helpers the operators share: input columns, word pattern, scratch tables, Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space is U+0020 and U+0009 to U+000D, as in the contracts of the queries.
WORD = r"[^\x20\x09-\x0D]+"
WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Rows of an Arrow batch handed to Python: texts may be long, so far below Spark's default of 10,000.
BATCH_ROWS = 1000
#: Texts are worked on together up to so many bytes; a longer one by itself.
CHUNK_BYTES = 4 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Keep what a Python worker holds at once small; a row is never cut."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def text_chunks(texts: pa.Array) -> Iterator[pa.Array]:
    """The texts of a batch in pieces of about CHUNK_BYTES, each of whole texts."""
    size = pc.cumulative_sum(pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())).to_numpy()
    at = 0
    while at < len(texts):
        limit = (size[at - 1] if at else 0) + CHUNK_BYTES
        to = max(at + 1, int(size.searchsorted(limit, side="right")))
        yield texts.slice(at, to - at)
        at = to


def text_or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else.  ``lower`` does just that where every character has one byte."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file; every operator also takes the path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


def worker_state(name: str, make):
    """A value made once per Python worker process and kept between its tasks (vocabularies, caches)."""
    import sys
    import types

    holder = sys.modules.setdefault("chorale_worker_state", types.ModuleType("chorale_worker_state"))
    if not hasattr(holder, name):
        setattr(holder, name, make())
    return getattr(holder, name)


def row_key(id_col: str, text_col: str) -> Column:
    """The same for rows with one id and one text, which are one document."""
    return F.xxhash64(F.col(id_col), F.col(text_col))


def wrapped(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc`` (the whole row), ``own_id`` and ``own_row`` (its row_key): no column of the input can clash with another."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(id_col).alias("own_id"),
                       row_key(id_col, text_col).alias("own_row"))


def one_of_equal(rows: DataFrame) -> DataFrame:
    """Of wrapped rows with one id and text a single one: that with the largest hash over all its columns, on every run."""
    rest = [c for c in rows.columns if c not in ("own_id", "own_row")]
    best = F.max_by(F.struct(*rest), F.xxhash64(F.to_json("doc")))
    return rows.groupBy("own_id", "own_row").agg(best.alias("best")).select("own_id", "own_row", *[F.col(f"best.{c}").alias(c) for c in rest])


def keep_once(docs: DataFrame, kept: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows of ``docs`` named by ``kept`` (id, row_key, times), all columns as they were.

    ``kept`` must be a written table.  Only rows that occur several times are looked at for repeats; of those that differ in
    other columns the same one is kept on every run.
    """
    k = kept.select(F.col("id").alias("kept_id"), F.col("row_key").alias("kept_row"), "times")
    own = wrapped(docs, id_col, text_col)
    on = F.col("own_id").eqNullSafe(F.col("kept_id")) & (F.col("own_row") == F.col("kept_row"))
    # Merged at every size, as both sides grow with the corpus.
    single = own.join(k.filter("times = 1").hint("merge"), on, "left_semi")
    repeated = one_of_equal(own.join(k.filter("times > 1"), on, "left_semi"))
    return single.select("doc.*").unionByName(repeated.select("doc.*"))
