"""Exact duplicates through an extendible-hash index kept in shared files.  DataFrame operations only.

1. *Entries*: one narrow row per document (64-bit key and SHA-256 of the normalised text), written once.
2. *Directory*: the leading bits of the key name a cell.  Starting with one bucket, every bucket that holds more than
   ``capacity`` distinct keys is split by the next bit, which doubles the directory, until none is overfull.  The number of bits
   follows the number of keys and rises while a cell is still overfull; the directory is a written table.
3. *Owners*: every document gets its bucket, a range of keys, from the directory; the owner of a bucket chains its rows by key **and
   by the text itself**, so texts that share a key but differ in a byte stay apart.  Copies are combined before the
   shuffle: a text that a third of all rows hold crosses it once per task.
4. *Index files*: one row per distinct text (bucket, key, SHA-256, row to keep, size), in the shared folder, by bucket.
5. Every document looks itself up in its bucket, by key and SHA-256.  The narrow rows of a hot text are split by the adaptive
   skew join; the other side has one row for it.

Defined results: a null text is empty text; a null id is smaller than every other; of repeated rows with the same id
and equal texts one stays; an empty table gives no rows; other columns of the input are not looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chorale.llm.common import ascii_lower, keep_once, row_key, text_or_empty
from chorale.session import materialise

#: Distinct keys of a bucket.
CAPACITY = 10_000
#: Bits by which cells are finer than buckets at first, and by which they get finer while one is overfull.
FINER, KEY_BITS = 4, 64


def _cell(key: Column, bits: int) -> Column:
    return F.shiftrightunsigned(key, KEY_BITS - bits) if bits else F.lit(0).cast("bigint")


def directory(entries: DataFrame, capacity: int) -> tuple[DataFrame, int]:
    """cell -> depth, bucket, as a written table, and the bits of a cell: the bucket of a cell has the fewest leading bits at
    which it is not overfull.  Keys of one value cannot be split: a cell of all 64 bits is a bucket in any case."""
    keys = materialise(entries.select("key").distinct(), "dedup-keys")
    bits = min(KEY_BITS, max(0, math.ceil(math.log2(max(keys.count(), 1) / capacity))) + FINER)
    while True:
        cells = materialise(keys.groupBy(_cell(F.col("key"), bits).alias("cell")).agg(F.count(F.lit(1)).alias("n")), "dedup-cells")
        if bits >= KEY_BITS or (cells.agg(F.max("n")).first()[0] or 0) <= capacity:
            break
        bits = min(KEY_BITS, bits + FINER)
    split = cells.select("cell", "n", F.explode(F.sequence(F.lit(0), F.lit(bits))).alias("depth"))
    split = split.withColumn("bucket", F.when(F.col("depth") == 0, 0).otherwise(F.call_function(
        "shiftrightunsigned", "cell", F.lit(bits) - F.col("depth"))).cast("bigint"))
    load = split.groupBy("depth", "bucket").agg(F.sum("n").alias("keys"))
    fits = load.filter((F.col("keys") <= capacity) | (F.col("depth") == bits))
    found = split.join(fits, ["depth", "bucket"]).groupBy("cell").agg(F.min(F.struct("depth", "bucket")).alias("at"))
    return materialise(found.select("cell", "at.depth", "at.bucket"), "dedup-directory"), bits


def placed(rows: DataFrame, owners: DataFrame, bits: int) -> DataFrame:
    """``rows`` (key, ...) with the depth and bucket of their key.  Spark knows the size of the directory, and broadcasts it only
    below its threshold."""
    return rows.withColumn("cell", _cell(F.col("key"), bits)).join(owners, "cell").drop("cell")


def build_index(docs: DataFrame, owners: DataFrame, bits: int, id_col: str, text_col: str) -> DataFrame:
    """One row per distinct text: depth, bucket, key, text_sha256, keep_id, group_size."""
    norm = ascii_lower(text_or_empty(text_col))
    texts = docs.select(F.col(id_col).alias("id"), norm.alias("norm")).withColumn("key", F.xxhash64("norm"))
    chains = placed(texts, owners, bits).groupBy("depth", "bucket", "key", "norm").agg(
        F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    rows = chains.select("depth", "bucket", "key", F.sha2("norm", 256).alias("text_sha256"), "keep_id", "group_size")
    return materialise(rows.repartition("depth", "bucket").sortWithinPartitions("depth", "bucket", "key"), "dedup-index")


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, bucket_depth, bucket."""
    norm = ascii_lower(text_or_empty(text_col))
    entries = docs.select(F.col(id_col).alias("doc_id"), norm.alias("norm")).select(
        "doc_id", F.xxhash64("norm").alias("key"), F.sha2("norm", 256).alias("text_sha256"))
    entries = materialise(entries, "dedup-entries")
    owners, bits = directory(entries, capacity)
    index = build_index(docs, owners, bits, id_col, text_col)
    # Repeated rows are counted, not listed: of ``times`` rows with one id and equal texts the first stays.
    rows = entries.groupBy("doc_id", "key", "text_sha256").agg(F.count(F.lit(1)).alias("times"))
    found = placed(rows, owners, bits).join(index, ["depth", "bucket", "key", "text_sha256"])
    found = found.withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)
    return found.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256",
                        F.col("depth").alias("bucket_depth"), "bucket", "times")


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they were."""
    keyed = docs.select(F.struct(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("row")).alias("who"),
                        F.col(text_col).alias("text"))
    kept = exact_duplicates(keyed, "who", "text").filter("kept").select("doc_id.id", F.col("doc_id.row").alias("row_key"), "times")
    return keep_once(docs, materialise(kept, "dedup-kept"), id_col, text_col)
