"""Token ids in grammar-compressed files (Re-Pair), in ascending document order, with random access.

*Encoding*: the tokenizer never joins characters across white space, so each different word is encoded once per worker
(a bounded table) and a document is its words' ids and an end id.

*Order*: documents are range-partitioned by id and sorted; a task packs its documents into shards of about
``shard_ids`` ids, never cutting a document.  Shard sizes alone give every document its place in the whole.

*Grammar*: per shard, frequent pairs of neighbouring symbols become rules, again and again with a falling threshold.
A round counts all pairs in a hash table (numpy), takes the frequent ones, and replaces their occurrences; where
occurrences overlap the more frequent pair wins.  Pairs never cross documents.

*File format*: Parquet rows, one a shard: ``part, shard`` (ascending with the document ids), ``n_docs, n_ids, base``
(symbols from ``base`` on are rules), and little-endian arrays: ``lengths`` (uint32, ids per document), ``symbols``
(uint32, symbols per document), ``rules`` (uint32 pairs), ``expansions`` (uint32, ids that a rule stands for) and
``sequence`` (``width`` bytes a symbol).  ``doc_ids`` is a list in the same order.  A reader finds a document by its symbol
offset and an id range inside it by the running sum of expansion lengths, without expanding anything else.

Defined results: a null text has the end id only; null ids come first; rows with equal ids are ordered by a hash of
the text, and equal rows are equal; an empty table gives no files with rows; a document longer than a shard is a shard
of its own; other columns are not read.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chorale.llm.common import small_batches, tokenizer_path, worker_state
from chorale.session import scratch_dir

VOCABULARY, END_ID = "word_bpe_49k.json", 1
SHARD_IDS = 1 << 20
MAX_RULES = 16_000
#: A round takes pairs that make up at least this share of a shard, then a quarter of it, down to ``MIN_COUNT``.
FIRST_SHARE, MIN_COUNT = 1 / 1024, 8
#: Words of each of the two tables a worker keeps, and words encoded in one call.
MAX_WORDS, MAX_WORD_CHARS, TOGETHER = 350_000, 64, 64
#: Words of Latin letters with at most one mark behind: composed letters whose lower case is one letter.
PLAIN = re.compile(r"[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0148\u014a-\u017e]+[.,]?").fullmatch
TABLE_BITS = 18


class WordIds:
    """Ids of texts as little-endian uint32 bytes; words are remembered."""

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.words: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.last = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        self.last[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True

    def encode(self, texts: list[str | None], end_id: int) -> list[bytes]:
        lists = [self._split(t) if t else [] for t in texts]
        every = set().union(*lists)
        if len(self.words) > MAX_WORDS:  # the words before the last change of tables are let go
            self.before, self.words = self.words, {}
        words, before, new = self.words, self.before, []
        for w in every - words.keys():
            known = before.get(w)
            if known is None:
                new.append(w)
            else:
                words[w] = known
        plain = [w for w in new if PLAIN(w)]
        self._together(plain)
        rest = [w for w in new if w not in words]
        for w, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)):
            words[w] = np.array(e.ids, "<u4").tobytes()
        end, get = np.array([end_id], "<u4").tobytes(), words.__getitem__
        out = [b"".join(map(get, ws)) + end for ws in lists]
        for w in new:
            if len(w) > MAX_WORD_CHARS:
                del words[w]
        return out

    def _together(self, words: list[str]) -> None:
        """Encode plain words many to a text, and cut the ids where the last id of a word or of its mark stands.

        Each run of letters, and each mark, ends in one id of ``self.last``; should that not add up for a text, its
        words are left for the other way.
        """
        groups = [words[i:i + TOGETHER] for i in range(0, len(words), TOGETHER)]
        for group, e in zip(groups, self.tokenizer.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)):
            ids = np.array(e.ids, "<u4")
            stops = np.flatnonzero(self.last[ids]) + 1
            runs = np.cumsum([1 if w[-1].isalpha() else 2 for w in group])
            if len(stops) != runs[-1] or stops[-1] != len(ids):
                continue
            raw, at = ids.tobytes(), 0
            for w, stop in zip(group, (4 * stops[runs - 1]).tolist()):
                self.words[w] = raw[at:stop]
                at = stop

    @staticmethod
    def _split(text: str) -> list[str]:
        for c in "\t\n\r":
            text = text.replace(c, " ")
        return text.split(" ")


def compress(ids: np.ndarray, doc_lengths: np.ndarray, base: int, max_rules: int = MAX_RULES) -> tuple:
    """(rules, expansions, sequence, symbols per document)."""
    # Two symbols make a key of 32 bits where they have 16, as in the files.
    kind, half = (np.uint32, 16) if base + max_rules <= 1 << 16 else (np.uint64, 32)
    odd, drop, low = kind(0x9E3779B97F4A7C15 >> (64 - 2 * half) | 1), kind(2 * half - TABLE_BITS), kind((1 << half) - 1)
    seq = ids.astype(kind)
    ends = np.zeros(len(seq), dtype=bool)
    ends[np.cumsum(doc_lengths) - 1] = True
    rules, sizes = np.zeros((0, 2), dtype=np.int64), np.zeros(0, dtype=np.int64)
    least = max(MIN_COUNT, int(len(seq) * FIRST_SHARE))
    while len(seq) > 1 and len(rules) < max_rules:
        key = seq[:-1] << kind(half) | seq[1:]
        slot = ((key * odd) >> drop).astype(np.intp)
        closed = np.flatnonzero(ends[:-1])
        count = np.bincount(slot, minlength=1 << TABLE_BITS) - np.bincount(slot[closed], minlength=1 << TABLE_BITS)
        busy = np.flatnonzero(count >= least)
        if len(busy) > max_rules - len(rules):
            busy = busy[np.argsort(-count[busy], kind="stable")[: max_rules - len(rules)]]
        weight = np.zeros(1 << TABLE_BITS, dtype=np.int64)
        weight[busy] = count[busy]
        # One pair stands for each slot; a pair that shares its slot with another waits for a later round.
        chosen = weight > 0
        marked = chosen[slot]
        marked[closed] = False
        at = np.flatnonzero(marked)
        pair = np.zeros(1 << TABLE_BITS, dtype=kind)
        pair[slot[at]] = key[at]
        at = at[pair[slot[at]] == key[at]]
        w = weight[slot[at]]
        next_to = np.diff(at) == 1
        before = np.zeros(len(at), dtype=np.int64)
        before[1:][next_to] = w[:-1][next_to]
        after = np.zeros(len(at), dtype=np.int64)
        after[:-1][next_to] = w[1:][next_to]
        # In a stretch of overlapping pairs of one count every second is taken; next to a more frequent one none.
        place = np.arange(len(at))
        stretch = np.maximum.accumulate(np.where(np.concatenate([[True], ~next_to | (w[1:] != w[:-1])]), place, 0)) if len(at) else place
        shift = (before[stretch] > w).astype(np.int64)
        at = at[((place - stretch - shift) % 2 == 0) & (place - stretch >= shift) & (after <= w)]
        if len(at):
            used, which = np.unique(slot[at], return_inverse=True)
            pairs = np.stack([pair[used] >> kind(half), pair[used] & low], axis=1).astype(np.int64)
            known = np.concatenate([np.ones(base, dtype=np.int64), sizes])
            first = base + len(rules)
            rules = np.concatenate([rules, pairs])
            sizes = np.concatenate([sizes, known[pairs[:, 0]] + known[pairs[:, 1]]])
            seq[at] = (first + which).astype(kind)
            ends[at] = ends[at + 1]
            keep = np.ones(len(seq), dtype=bool)
            keep[at + 1] = False
            seq, ends = seq[keep], ends[keep]
        elif least == MIN_COUNT:
            break
        least = max(MIN_COUNT, least // 4)
    stops = np.flatnonzero(ends) + 1
    return rules, sizes, seq, np.diff(np.concatenate([[0], stops]))


def expand(sequence: np.ndarray, rules: np.ndarray, base: int) -> np.ndarray:
    """Ids that a sequence of symbols stands for."""
    seq = sequence.astype(np.int64)
    while True:
        at = np.flatnonzero(seq >= base)
        if not len(at):
            return seq
        to = np.arange(len(seq))
        step = np.zeros(len(seq) + 1, dtype=np.int64)
        step[at + 1] = 1
        to += np.cumsum(step)[:-1]
        out = np.empty(len(seq) + len(at), dtype=np.int64)
        pairs = rules[seq[at] - base]
        out[to] = seq
        out[to[at]] = pairs[:, 0]
        out[to[at] + 1] = pairs[:, 1]
        seq = out


def expand_shard(sequence: np.ndarray, rules: np.ndarray, expansions: np.ndarray, base: int) -> np.ndarray:
    """The same for a whole shard: every rule is expanded once, and all symbols are looked up in one go."""
    table = np.concatenate([np.arange(base), expand(np.arange(base, base + len(rules)), rules, base)]).astype("<u4")
    size_of = np.concatenate([np.ones(base, dtype=np.int64), expansions])
    start_of = np.cumsum(size_of) - size_of
    symbols = sequence.astype(np.intp)
    n = size_of[symbols]
    stops = np.cumsum(n)
    place = np.repeat(start_of[symbols] - (stops - n), n)
    place += np.arange(len(place))
    return table[place]


def expand_range(sequence: np.ndarray, rules: np.ndarray, expansions: np.ndarray, base: int, start: int, stop: int) -> np.ndarray:
    """Ids start..stop of what a sequence stands for; only the symbols that cover them are expanded."""
    plain = sequence < base
    size = np.ones(len(sequence), dtype=np.int64)
    size[~plain] = expansions[sequence[~plain].astype(np.int64) - base]
    to = np.cumsum(size)
    stop = min(stop, int(to[-1]) if len(to) else 0)
    if start >= stop:
        return np.zeros(0, dtype=np.int64)
    a, b = np.searchsorted(to, start, side="right"), np.searchsorted(to, stop, side="left")
    skipped = int(to[a - 1]) if a else 0
    return expand(sequence[a:b + 1], rules, base)[start - skipped:stop - skipped]


def _shard_row(part: int, shard: int, doc_ids: list, blobs: list[bytes], base: int, kind: pa.DataType) -> pa.RecordBatch:
    ids = np.frombuffer(b"".join(blobs), "<u4")
    lengths = np.array([len(b) // 4 for b in blobs], dtype=np.int64)
    rules, sizes, seq, symbols = compress(ids, lengths, base)
    width = 2 if base + len(rules) <= 1 << 16 else 4
    four = lambda a: a.astype("<u4").tobytes()
    values = [part, shard, len(doc_ids), len(ids), base, width, doc_ids, four(lengths), four(symbols), four(rules),
              four(sizes), seq.astype(f"<u{width}").tobytes()]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(kind)] + [pa.binary()] * 5
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)], _FIELDS)


_FIELDS = ["part", "shard", "n_docs", "n_ids", "base", "width", "doc_ids", "lengths", "symbols", "rules", "expansions", "sequence"]


def write_token_files(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", vocabulary_path: str | None = None,
    end_id: int = END_ID, shard_ids: int = SHARD_IDS,
) -> None:
    with open(vocabulary_path or tokenizer_path(VOCABULARY), encoding="utf-8") as f:
        vocabulary = f.read()  # two megabytes; they go to the workers with the task
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_state(f"word_ids_{hash(vocabulary)}", lambda: WordIds(vocabulary))
        base = encoder.tokenizer.get_vocab_size()
        part, shard, ids, blobs, held, kind = TaskContext.get().partitionId(), 0, [], [], 0, None
        for b in batches:
            kind = b.column(0).type
            for doc_id, blob in zip(b.column(0).to_pylist(), encoder.encode(b.column(1).to_pylist(), end_id)):
                if held and held + len(blob) > 4 * shard_ids:
                    yield _shard_row(part, shard, ids, blobs, base, kind)
                    shard, ids, blobs, held = shard + 1, [], [], 0
                ids.append(doc_id)
                blobs.append(blob)
                held += len(blob)
        if ids:
            yield _shard_row(part, shard, ids, blobs, base, kind)

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)
    schema = (f"part int, shard int, n_docs bigint, n_ids bigint, base int, width int, doc_ids array<{dict(rows.dtypes)['doc_id']}>, "
              "lengths binary, symbols binary, rules binary, expansions binary, sequence binary")
    ordered.mapInArrow(run, schema).write.parquet(path)


def shard_starts(shards: DataFrame) -> DataFrame:
    """part, shard -> ids of all shards before it.  One row per task is summed in order, then one per shard in its task."""
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))
    parts = parts.withColumn("part_start", F.coalesce(F.sum("part_ids").over(before(Window.orderBy("part"))), F.lit(0)))
    own = F.coalesce(F.sum("n_ids").over(before(Window.partitionBy("part").orderBy("shard"))), F.lit(0))
    placed = shards.select("part", "shard", "n_ids", own.alias("own")).join(parts, "part")
    return placed.select("part", "shard", (F.col("part_start") + F.col("own")).cast("bigint").alias("shard_start"))


def _arrays(r: dict) -> tuple:
    rules = np.frombuffer(r["rules"], "<u4").astype(np.int64).reshape(-1, 2)
    return (np.frombuffer(r["sequence"], f"<u{r['width']}"), rules, np.frombuffer(r["expansions"], "<u4").astype(np.int64),
            np.frombuffer(r["lengths"], "<u4").astype(np.int64), np.frombuffer(r["symbols"], "<u4").astype(np.int64))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (little-endian uint32), ids_crc32."""
    shards = spark.read.parquet(path)
    kind = dict(shards.dtypes)["doc_ids"][len("array<"):-1]
    names = ["part", "shard", "doc_id", "own_start", "n_tokens", "ids", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            doc_kind = b.schema.field("doc_ids").type.value_type
            for k in range(b.num_rows):
                r = {n: b.column(i)[k].as_py() for i, n in enumerate(b.schema.names)}
                seq, rules, sizes, lengths, _ = _arrays(r)
                ids = expand_shard(seq, rules, sizes, r["base"]).tobytes()
                stops = np.cumsum(lengths)
                blobs = [ids[4 * (e - n):4 * e] for e, n in zip(stops.tolist(), lengths.tolist())]
                n = len(blobs)
                yield pa.RecordBatch.from_arrays([
                    pa.array([r["part"]] * n, pa.int32()), pa.array([r["shard"]] * n, pa.int32()),
                    pa.array(r["doc_ids"], doc_kind), pa.array(stops - lengths), pa.array(lengths),
                    pa.array(blobs, pa.binary()), pa.array([zlib.crc32(x) for x in blobs], pa.int64())], names)

    docs = shards.mapInArrow(run, f"part int, shard int, doc_id {kind}, own_start bigint, n_tokens bigint, ids binary, ids_crc32 bigint")
    starts = shard_starts(shards.select("part", "shard", "n_ids"))
    start = (F.col("shard_start") + F.col("own_start")).alias("start")
    return docs.join(starts, ["part", "shard"]).select("doc_id", start, "n_tokens", "ids", "ids_crc32")


def read_ranges(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """Random access: ``wanted`` has doc_id, from_id, to_id; gives them with ids (array<int>), nothing else expanded."""
    shards = spark.read.parquet(path)
    places = shards.select("part", "shard", F.posexplode("doc_ids").alias("nth", "doc_id")).join(wanted, "doc_id")
    asked = places.groupBy("part", "shard").agg(F.collect_list(F.struct("doc_id", "nth", "from_id", "to_id")).alias("asked"))
    kind = dict(shards.dtypes)["doc_ids"][len("array<"):-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                seq, rules, sizes, _, symbols = _arrays(r)
                stops = np.cumsum(symbols)
                out = [(q["doc_id"], q["from_id"], q["to_id"], expand_range(
                    seq[stops[q["nth"]] - symbols[q["nth"]]:stops[q["nth"]]], rules, sizes, r["base"], q["from_id"], q["to_id"]))
                    for q in r["asked"]]
                d, f, t, ids = zip(*out)
                yield pa.RecordBatch.from_arrays([
                    pa.array(d, b.schema.field("doc_ids").type.value_type), pa.array(f, pa.int64()), pa.array(t, pa.int64()),
                    pa.array([x.tolist() for x in ids], pa.list_(pa.int32()))], ["doc_id", "from_id", "to_id", "ids"])

    return shards.join(asked, ["part", "shard"]).mapInArrow(
        run, f"doc_id {kind}, from_id bigint, to_id bigint, ids array<int>")


def token_files(docs: DataFrame, **how) -> DataFrame:
    """Write the files to the shared folder and read them back."""
    spark = docs.sparkSession
    path = scratch_dir(spark, "token-files")
    write_token_files(docs, path, **how)
    return read_token_files(spark, path)
