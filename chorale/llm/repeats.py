"""Removal of long repeated byte strings, by suffix arrays.

A byte goes if it is covered by a string of ``length`` bytes that also starts somewhere else, in the same or another document.

1. *Dealing.*  Every window of ``length`` bytes has an anchor: the ``ANCHOR``-byte string in it with the least hash (the
   first, if several).  Equal windows have equal anchors at the same place, so all copies of a window can meet by
   anchor.  Neighbouring windows with one anchor are one *segment*; segments with equal bytes are one *class*.
   Anchors that occur once are done with; so are classes that occur twice or more (all their windows repeat).
2. *Shards.*  For anchors with several classes the bytes of one segment of each class are sent to shards of about
   ``shard_bytes``.  A shard sorts its suffixes by Larsson-Sadakane refinement (numpy: groups of equal prefixes are
   refined by the ranks ``h`` bytes on, h doubling; sorted suffixes take no more part), gets common prefixes as Kasai does (a
   suffix's common prefix follows from that of the suffix before it, except where the characters in front differ), and
   marks windows whose common prefix with a neighbour is long enough.
3. *Merging.*  An anchor with more bytes than half a shard is cut into slices on several shards.  Their sorted windows meet
   again by ranges of window fingerprints (128 bits), and each run is looked up in the others by binary search.
4. Marked ranges are gathered per document and the rest of the text is put together.

Texts are moved once, for the documents with a repeated anchor; copies are combined first; a passage that a third of all
documents hold is one class per stretch.  Equality of classes is that of two 64-bit hashes (anchor and content).

Defined results: a null text is empty; shorter texts lose nothing; a null id is kept; repeated rows are repeats of one
another; an empty table gives no rows; very long texts are worked on in pieces that overlap; columns other than id
and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chorale.llm.common import row_key, small_batches, text_or_empty
from chorale.llm.jaccard import mix
from chorale.session import materialise

LENGTH, ANCHOR = 200, 24
SHARD_BYTES = 2 << 20
PIECE = 1 << 20
_GAP = 0xFF  # occurs in no UTF-8 text
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _anchor_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ANCHOR (24) bytes from each position on, by doubling: 1, 2, 4, 8, 16, 16 + 8."""
    with np.errstate(over="ignore"):
        h, width, eight = mix(data.astype(np.uint64) + np.uint64(1)), 1, None
        while width < 16:
            h = mix(h[:-width] * _ODD + h[width:])
            width *= 2
            eight = h if width == 8 else eight
        return mix(h[:len(data) - ANCHOR + 1] * _ODD + eight[16:])


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours: of two blocks, the end of the one and the start of the other."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def segments(raw: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, size, anchor, content) of the segments of a text; two segments overlap by ``length - 1`` bytes."""
    import xxhash

    found: list[tuple] = []
    for base in range(0, max(len(raw) - length + 1, 0), PIECE):
        part = raw[base:base + PIECE + length - 1]
        data = np.frombuffer(part, np.uint8)
        hashes = _anchor_hashes(data)
        place = np.arange(len(hashes), dtype=np.uint64)
        low = np.uint64((1 << 24) - 1)
        least = (_sliding_least((hashes & ~low) | place, length - ANCHOR + 1) & low).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        stop = np.concatenate([first[1:], [len(least)]]) + length - 1
        content = [xxhash.xxh3_64_intdigest(part[a:b]) for a, b in zip(first.tolist(), stop.tolist())]
        found.append((first + base, stop - first, hashes[least[first]], np.array(content, dtype=np.uint64)))
    if not found:
        return tuple(np.zeros(0, dtype=t) for t in (np.int64, np.int64, np.uint64, np.uint64))
    return tuple(np.concatenate(x) for x in zip(*found))


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, as a number that sorts like them; zeros behind the end."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    w = np.zeros(len(text), dtype=np.uint64)
    for i in range(8):
        w = (w << np.uint64(8)) | padded[i:i + len(text)]
    return w


def suffix_array(text: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Larsson-Sadakane: suffixes sorted by eight bytes, then groups of equals by the rank of what follows."""
    n = len(text)
    sa = np.argsort(words)
    sorted_words = words[sa]
    new = np.concatenate([[True], sorted_words[1:] != sorted_words[:-1]])
    head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, dtype=np.int64)
    rank[sa] = head
    h = 8
    # Zeros that were added behind the end may equal bytes of the text, so the first ranks are of eight bytes or the end.
    slots = np.flatnonzero(~(new & np.concatenate([new[1:], [True]])))
    while len(slots):
        at = sa[slots]
        behind = at + h
        follow = np.where(behind < n, rank[np.minimum(behind, n - 1)] + 1, 0)
        # One number for group and follower: equal ones need no order, which a later round gives them.
        key = rank[at] * (n + 1) + follow
        order = np.argsort(key)
        at, key = at[order], key[order]
        sa[slots] = at
        new = np.concatenate([[True], key[1:] != key[:-1]])
        rank[at] = np.maximum.accumulate(np.where(new, slots, 0))
        alone = new & np.concatenate([new[1:], [True]])
        slots = slots[~alone]
        h *= 2
    return sa


def common_prefixes(text: np.ndarray, words: np.ndarray, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(before, length): for each position the suffix sorted just before its own (-1: none) and their common prefix.

    Kasai: from one position to the next the common prefix loses one character as long as the characters in front
    are equal; only where they differ is it compared, eight bytes at a time.
    """
    n = len(text)
    before = np.full(n, -1, dtype=np.int64)
    before[sa[1:]] = sa[:-1]
    index = np.arange(n)
    follows = (index > 0) & (before > 0)
    follows[1:] &= text[:-1] == text[before[1:] - 1]
    size = np.zeros(n, dtype=np.int64)
    todo = np.flatnonzero(~follows & (before >= 0))
    done = 0
    while len(todo):
        a, b = todo + done, before[todo] + done
        inside = (a < n) & (b < n)
        todo, a, b = todo[inside], a[inside], b[inside]
        x = words[a] ^ words[b]
        equal = np.zeros(len(todo), dtype=np.int64)
        for k in range(1, 9):
            equal += (x >> np.uint64(64 - 8 * k)) == 0
        size[todo] = np.minimum(done + equal, n - np.maximum(todo, before[todo]))
        todo = todo[equal == 8]
        done += 8
    source = np.maximum.accumulate(np.where(follows, 0, index))
    size = np.maximum(size[source] - (index - source), 0)
    size[before < 0] = 0
    return before, size


def repeated_starts(parts: list[bytes], length: int) -> np.ndarray:
    """For the parts set one after the other with a gap behind each: whether a repeated window starts there."""
    text = np.frombuffer(b"".join(p + bytes([_GAP]) for p in parts), np.uint8)
    words = _words(text)
    before, size = common_prefixes(text, words, suffix_array(text, words))
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    left = np.repeat(ends, [len(p) + 1 for p in parts]) - np.arange(len(text))
    hit = np.flatnonzero((size >= length) & (left >= length))
    marked = np.zeros(len(text), dtype=bool)
    marked[hit] = True
    marked[before[hit]] = True
    return marked


def _runs(marked: np.ndarray) -> tuple[list[int], list[int]]:
    edge = np.diff(np.concatenate([[0], marked.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()


def _shard_ranges(shards: DataFrame, length: int) -> DataFrame:
    """shards (shard, sliced, anchor, content, bytes) -> anchor, content, from, to (window starts), or for the windows of
    sliced anchors their fingerprints: slice, print (16 bytes), ``to`` = ``from`` if the window is known to repeat."""
    schema = "anchor bigint, content bigint, `from` int, `to` int, slice bigint, print binary"

    def work(shard: int, rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        marked = repeated_starts([r[3] for r in rows], length)
        out: list[tuple] = []
        shown: set[tuple] = set()
        at = 0
        for sliced, anchor, content, raw in rows:
            own = marked[at:at + len(raw)]
            out += [(anchor, content, a, b, None, None) for a, b in zip(*_runs(own))]
            if sliced:
                for i in range(len(raw) - length + 1):
                    mark = hashlib.blake2b(raw[i:i + length], digest_size=16).digest()
                    # Of windows that repeat in this slice one is shown to the others; the rest want to know of theirs.
                    if own[i] and (anchor, mark) in shown:
                        continue
                    shown.add((anchor, mark))
                    out.append((anchor, content, i, i if own[i] else i + 1, shard, mark))
            at += len(raw) + 1
        if out:
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                                             ["anchor", "content", "from", "to", "slice", "print"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, shard = [], None
        for b in batches:
            for s, *row in zip(*[b.column(i).to_pylist() for i in range(5)]):
                if s != shard and rows:
                    yield from work(shard, rows)
                    rows = []
                shard = s
                rows.append(tuple(row))
        if rows:
            yield from work(shard, rows)

    return shards.mapInArrow(run, schema)


def _merge(prints: DataFrame, rows_per_range: int = 50_000) -> DataFrame:
    """prints (anchor, content, from, slice, print) -> anchor, content, from, to of windows that another slice holds too and that are not known yet."""
    per_anchor = prints.groupBy("anchor").agg(F.ceil(F.count(F.lit(1)) / F.lit(rows_per_range)).alias("ranges"))
    lead = F.conv(F.hex(F.substring("print", 1, 4)), 16, 10).cast("bigint")
    dealt = prints.join(per_anchor, "anchor").withColumn("range", F.floor(lead * F.col("ranges") / F.lit(1 << 32)))
    dealt = dealt.repartition("anchor", "range")

    def merge(table: pa.Table) -> pa.Table:
        t = {n: table.column(n).to_numpy(zero_copy_only=False) for n in ("slice", "from", "to")}
        keys = np.frombuffer(b"".join(x.as_py() for x in table.column("print")), dtype=">u8").reshape(-1, 2)
        keys = keys.astype(np.uint64).view([("a", np.uint64), ("b", np.uint64)]).ravel()
        hit = np.zeros(len(keys), dtype=bool)
        slices = np.unique(t["slice"])
        runs = {s: np.unique(keys[t["slice"] == s]) for s in slices}
        for s in slices:
            own = np.flatnonzero((t["slice"] == s) & (t["to"] > t["from"]))
            for other in slices:
                if other == s:
                    continue
                run = runs[other]
                at = np.minimum(np.searchsorted(run, keys[own]), len(run) - 1)
                hit[own] |= run[at] == keys[own]
        return table.filter(pa.array(hit)).select(["anchor", "content", "from", "to"])

    return dealt.groupBy("anchor", "range").applyInArrow(merge, "anchor bigint, content bigint, `from` int, `to` int")


def removed_ranges(docs: DataFrame, id_col: str, text_col: str, length: int, shard_bytes: int) -> tuple[DataFrame, DataFrame]:
    """(row_key, gone: array of struct(from, to) of window starts that repeat) and the texts (row_key, raw) they are of."""
    small_batches(docs.sparkSession)
    text = docs.select(row_key(id_col, text_col).alias("row_key"), F.encode(text_or_empty(text_col), "UTF-8").alias("raw"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 100):
                own = b.slice(lo, 100)
                parts = [segments(r, length) for r in own.column(1).to_pylist()]
                keys = np.repeat(own.column(0).to_numpy(), [len(p[0]) for p in parts])
                start, size, anchor, content = (np.concatenate(x) for x in zip(*parts))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array(start.astype(np.int32)), pa.array(size.astype(np.int32)),
                     pa.array(anchor.view(np.int64)), pa.array(content.view(np.int64))],
                    ["row_key", "start", "size", "anchor", "content"])

    all_segments = text.filter(F.octet_length("raw") >= length).mapInArrow(
        cut, "row_key bigint, start int, size int, anchor bigint, content bigint")
    by_anchor = Window.partitionBy("anchor")
    counted = all_segments.withColumn("g", F.count(F.lit(1)).over(by_anchor)).filter("g > 1")
    by_class = Window.partitionBy("anchor", "content")
    counted = counted.withColumn("n", F.count(F.lit(1)).over(by_class))
    counted = counted.withColumn("classes", F.sum(1 / F.col("n")).over(by_anchor) > 1.5)
    met = materialise(counted.drop("g"), "repeat-segments")

    needed = met.select("row_key").distinct()
    texts = text.join(materialise(needed, "repeat-rows"), "row_key", "left_semi")
    texts = materialise(texts.groupBy("row_key").agg(F.first("raw").alias("raw")), "repeat-texts")

    one = met.filter("classes").groupBy("anchor", "content").agg(F.min(F.struct("row_key", "start", "size")).alias("of"))
    one = one.select("anchor", "content", "of.*")
    volume = one.groupBy("anchor").agg(F.sum("size").alias("bytes")).withColumn(
        "slices", F.ceil(2 * F.col("bytes") / F.lit(shard_bytes)).cast("bigint"))
    volume = materialise(volume, "repeat-anchors")
    shards = max(1, -(-int(volume.agg(F.sum("bytes")).first()[0] or 0) // shard_bytes))
    dealt = one.join(volume.select("anchor", "slices"), "anchor")
    spot = F.pmod(F.xxhash64("anchor", F.pmod("content", "slices")), F.lit(shards))
    dealt = dealt.withColumn("shard", spot).withColumn("sliced", F.col("slices") > 1)
    asked = dealt.groupBy("row_key").agg(F.collect_list(F.struct("shard", "sliced", "anchor", "content", "start", "size")).alias("asked"))

    piece = F.expr("transform(asked, x -> struct(x.shard, x.sliced, x.anchor, x.content, substring(raw, x.start + 1, x.size) AS raw))")
    sent = asked.join(texts, "row_key").select(F.explode(piece).alias("p")).select("p.*")
    # A shard's rows come one after the other; tasks hold one shard at a time.
    sent = sent.repartition(shards, "shard").sortWithinPartitions("shard")
    ranges = materialise(_shard_ranges(sent, length), "repeat-ranges")
    within = ranges.filter("slice IS NULL").select("anchor", "content", "from", "to")
    if not volume.filter("slices > 1").isEmpty():
        within = within.unionByName(_merge(ranges.filter("slice IS NOT NULL")))
    # Classes that occur once get what the shards found; the others repeat as a whole.
    once = met.filter("classes AND n = 1").join(within, ["anchor", "content"]).select(
        "row_key", (F.col("start") + F.col("from")).alias("from"), (F.col("start") + F.col("to")).alias("to"))
    whole = met.filter("n > 1").select("row_key", F.col("start").alias("from"), (F.col("start") + F.col("size") - (length - 1)).alias("to"))
    gone = once.unionByName(whole).groupBy("row_key").agg(F.collect_set(F.struct("from", "to")).alias("gone"))
    return gone, texts


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, removed (array of byte ranges), kept_sha256, kept (binary; null if nothing went).

    What is left may end or begin inside a character, so it is binary.
    """
    if length < 2 * ANCHOR:
        raise ValueError(f"length must be at least {2 * ANCHOR}")
    rows = docs.select(F.col(id_col).alias("doc_id"), row_key(id_col, text_col).alias("row_key"),
                       F.octet_length(text_or_empty(text_col)).cast("bigint").alias("n_bytes"), F.sha2(text_or_empty(text_col), 256).alias("whole"))
    gone, texts = removed_ranges(docs, id_col, text_col, length, shard_bytes)

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for key, raw, ranges in zip(*[b.column(i).to_pylist() for i in range(3)]):
                edge = np.zeros(len(raw) + 1, dtype=np.int64)
                np.add.at(edge, [r["from"] for r in ranges], 1)
                np.add.at(edge, [r["to"] + length - 1 for r in ranges], -1)
                away = np.cumsum(edge)[:-1] > 0
                kept = np.frombuffer(raw, np.uint8)[~away].tobytes()
                spans = [{"from": x, "to": y} for x, y in zip(*_runs(away))]
                out.append((key, int(away.sum()), len(spans), spans, hashlib.sha256(kept).hexdigest(), kept))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())])), pa.string(), pa.binary()]
            names = ["row_key", "n_removed", "n_spans", "removed", "kept_sha256", "kept"]
            columns = zip(*out) if out else [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    stripped = texts.join(gone, "row_key").select("row_key", "raw", "gone").mapInArrow(
        strip, "row_key bigint, n_removed bigint, n_spans bigint, removed array<struct<`from`:int,`to`:int>>, kept_sha256 string, kept binary")
    zero = F.lit(0).cast("bigint")
    return rows.join(stripped, "row_key", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"),
        "removed", F.coalesce("kept_sha256", "whole").alias("kept_sha256"), "kept")
