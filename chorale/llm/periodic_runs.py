"""Periodic runs of words (loops of a generator, repeated menus and boilerplate), and texts with the repeats collapsed.

A *run* is a stretch of consecutive words that repeats with smallest period q (words q apart are identical), is at least
``min_words`` words and ``min_periods`` periods long, and that no neighbouring word extends.

*Recursive frequency splitting*: every word of a run occurs at least ``min_periods`` times in it.  So a word that occurs
less often in its segment (at first the whole text) lies in no run and splits the segment there; pieces shorter than
``min_words`` go, and the others are counted again until nothing splits.  Counts come from one sort by (text, word): the
places of a word in a segment are neighbours in that order, so a round costs the words of the segments that changed.  A
run lies in one surviving segment as a whole, and what ends it there ends it in the text.

*Lag scan* of the surviving segments: small lags are compared word by word.  A run of a lag from K to 2K holds an aligned
tile of K/2 words that occurs again one lag later, so for larger lags only those at which a tile occurs again are
scanned: at most two per word and doubling of K, in any text.  Tiles that match one after the other at a lag are joined,
and both ends are found by halving steps over the names of stretches of 1, 2, 4, ... words.  A stretch that is found at
several lags counts with the smallest, of which the others are multiples.

A text's work is of the order n log(n)^2 and its memory about 100 bytes a word and doubling; texts never meet, so nothing
is shuffled and a lost executor costs only its tasks.

Defined results: a null, empty or blank text has no words, no runs and collapses to the empty text; a null id is kept;
repeated rows give repeated rows; an empty table gives no rows; very long texts are read whole, by themselves; ties
(runs of equal length) are all listed, by start, then period; columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chorale.llm.common import WORD, small_batches, text_chunks, text_or_empty

#: Lags below this are compared word by word; a power of two from 4 on.
PLAIN_LAGS = 16

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def split_rare(codes: np.ndarray, text_of: np.ndarray, times: int, min_words: int) -> np.ndarray:
    """Segment of each word, -1 for words that lie in no run.  ``codes``: numbers of (text, word); texts follow each other."""
    segment = text_of.astype(np.int64)
    order = np.argsort(codes, kind="stable")
    next_id = int(segment[-1]) + 1 if len(segment) else 0
    while len(order):
        c, s = codes[order], segment[order]
        first = np.flatnonzero(np.concatenate([[True], (c[1:] != c[:-1]) | (s[1:] != s[:-1])]))
        count = np.diff(np.append(first, len(order)))
        rare = np.repeat(count < times, count)
        if not rare.any():
            break
        segment[order[rare]] = -1
        # Only segments that lost a word are cut and counted again.
        touched = np.unique(s[rare])
        at = np.searchsorted(touched, s)
        again = ~rare & (touched[np.minimum(at, len(touched) - 1)] == s)
        places = np.sort(order[again])
        if not len(places):
            break
        old = segment[places]
        begins = np.concatenate([[True], (np.diff(places) > 1) | (old[1:] != old[:-1])])
        piece = np.cumsum(begins) - 1
        size = np.bincount(piece)
        long = size[piece] >= min_words
        segment[places] = np.where(long, piece + next_id, -1)
        next_id += len(size)
        order = order[again]
        order = order[segment[order] >= 0]
    return segment


def _stretches(equal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of True."""
    edge = np.diff(np.concatenate([[False], equal, [False]]).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _name_pairs(names: np.ndarray, step: int) -> np.ndarray:
    """Names of stretches of twice ``step`` words; those that reach over the end have names of their own."""
    n = len(names)
    second = np.arange(n, dtype=np.int64) + n
    second[:max(n - step, 0)] = names[step:]
    return np.unique(names * np.int64(2 * n) + second, return_inverse=True)[1].astype(np.int64)


def _extend(names: list[np.ndarray], level: int, at: np.ndarray, lag: np.ndarray, forward: bool) -> np.ndarray:
    """How many words more (fewer than 2 ** level) agree at the lag, from ``at`` on or before it."""
    n = len(names[0])
    more = np.zeros(len(at), dtype=np.int64)
    for j in range(level - 1, -1, -1):
        step = 1 << j
        here = at + more if forward else at - more - step
        inside = (here >= 0) & (here + lag + step <= n)
        same = np.zeros(len(at), dtype=bool)
        i = here[inside]
        same[inside] = names[j][i] == names[j][i + lag[inside]]
        more += np.where(same, step, 0)
    return more


def _long_lags(x: np.ndarray, longest: int, min_words: int, min_periods: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Stretches at lags from PLAIN_LAGS on: start, length, lag."""
    names = [np.unique(x, return_inverse=True)[1].astype(np.int64)]
    k = PLAIN_LAGS
    while min_periods * k <= longest:
        level = (k // 2).bit_length() - 1
        while len(names) <= level:
            names.append(_name_pairs(names[-1], 1 << (len(names) - 1)))
        own, n = names[level], len(x)
        order = np.argsort(own, kind="stable")
        keys = own[order] * np.int64(n + 1) + order
        if keys[-1] // (n + 1) == n - 1:  # no stretch of this length occurs twice, so no longer one does
            return
        tiles = np.arange(0, n, k // 2)
        lo = np.searchsorted(keys, own[tiles] * (n + 1) + np.minimum(tiles + k, n))
        hi = np.searchsorted(keys, own[tiles] * (n + 1) + np.minimum(tiles + 2 * k, n))
        found = hi - lo
        if found.any():
            nth = np.repeat(np.arange(len(tiles)), found)
            inside = np.arange(found.sum()) - np.repeat(np.cumsum(found) - found, found)
            lag = order[np.repeat(lo, found) + inside] - tiles[nth]
            by_lag = np.lexsort((nth, lag))
            nth, lag = nth[by_lag], lag[by_lag]
            begins = np.concatenate([[True], (np.diff(nth) != 1) | (np.diff(lag) != 0)])
            first = np.flatnonzero(begins)
            last = np.append(first[1:], len(nth)) - 1
            start, stop, q = tiles[nth[first]], tiles[nth[last]] + k // 2, lag[first]
            start = start - _extend(names, level, start, q, False)
            stop = stop + _extend(names, level, stop, q, True)
            length = stop - start + q
            long = length >= np.maximum(min_words, min_periods * q)
            yield start[long], length[long], q[long]
        k *= 2


def find(codes: np.ndarray, text_of: np.ndarray, min_words: int = 12, min_periods: int = 2) -> tuple[np.ndarray, ...]:
    """Start, length and smallest period of every run, by start, then period; starts count over all texts."""
    none = np.zeros(0, dtype=np.int64)
    if not len(codes):
        return none, none, none
    segment = split_rare(codes, text_of, min_periods, min_words)
    places = np.flatnonzero(segment >= 0)
    if not len(places):
        return none, none, none
    # The surviving segments side by side, a word of its own behind each, so that nothing agrees across them.
    own = segment[places]
    last = np.flatnonzero(np.append(own[1:] != own[:-1], True))
    to = np.arange(len(places)) + np.searchsorted(last, np.arange(len(places)))
    n = len(places) + len(last)
    x, origin = np.arange(n, dtype=np.int64) + int(codes.max()) + 1, np.full(n, -1, dtype=np.int64)
    x[to], origin[to] = codes[places], places
    longest = int(np.diff(np.concatenate([[-1], last])).max())

    found = []
    for q in range(1, min(PLAIN_LAGS - 1, longest // min_periods) + 1):
        start, stop = _stretches(x[:-q] == x[q:])
        long = stop - start + q >= max(min_words, min_periods * q)
        if long.any():
            start, stop = start[long], stop[long]
            found.append((start, stop - start + q, np.full(len(start), q, dtype=np.int64)))
    found += _long_lags(x, longest, min_words, min_periods)
    if not found:
        return none, none, none
    start, length, period = (np.concatenate(v) for v in zip(*found))
    by = np.lexsort((period, length, start))
    start, length, period = start[by], length[by], period[by]
    once = np.concatenate([[True], (np.diff(start) != 0) | (np.diff(length) != 0)])
    start, length, period = origin[start[once]], length[once], period[once]
    by = np.lexsort((period, start))
    return start[by], length[by], period[by]


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts in one array, and where each text's begin (with the end of the last one)."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    offsets = lists.offsets.to_numpy().astype(np.int64)
    words = lists.flatten()
    full = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
    before = np.concatenate([[0], np.cumsum(full)])
    return words.filter(pa.array(full)), before[offsets - offsets[0]]


def runs_of(texts: pa.Array, min_words: int, min_periods: int) -> tuple[pa.Array, pa.Array, pa.Array]:
    """n_words, runs and collapsed text of each text."""
    words, offsets = words_of(texts)
    n = np.diff(offsets)
    text_of = np.repeat(np.arange(len(n)), n)
    code = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    codes = text_of * np.int64(len(words) + 1) + code
    start, length, period = find(codes, text_of, min_words, min_periods)
    covered = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(covered, start + period, 1)
    np.add.at(covered, start + length, -1)
    kept = np.cumsum(covered)[:-1] == 0
    left = np.concatenate([[0], np.cumsum(kept)])[offsets]
    collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(left, pa.int32()), words.filter(pa.array(kept))), " ")
    of = np.searchsorted(offsets, start, side="right") - 1
    per_text = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(n)))]) if len(n) else np.zeros(1)
    # A text without words shares its offset with the next one; a run belongs to the last text that begins there.
    runs = pa.StructArray.from_arrays([pa.array(start - offsets[of]), pa.array(length), pa.array(period)], ["start", "length", "period"])
    return pa.array(n), pa.ListArray.from_arrays(pa.array(per_text.astype(np.int32)), runs), collapsed


def find_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 12, min_periods: int = 2
) -> DataFrame:
    """doc_id, n_words, runs (start, length, period in words, by start, then period), collapsed: the words but those that
    some run holds after its first period, joined by one space."""
    if min_periods < 2 or min_words < 2:
        raise ValueError("a run has at least two words and two periods")
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = 0
            for texts in text_chunks(b.column(1)):
                n, runs, collapsed = runs_of(texts, min_words, min_periods)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(texts)), n, runs, collapsed],
                                                 ["doc_id", "n_words", "runs", "collapsed"])
                at += len(texts)

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, n_words bigint, runs {RUNS}, collapsed string")


def looped(id_col: Column, text: Column) -> Column:
    """The text, looped from some word on for about every tenth id (by the crc32 of its decimals): what op11 looks at."""
    h = F.crc32(id_col.cast("string"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))

    def loop(w: Column) -> Column:
        n = F.size(w).cast("bigint")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        times = F.ceil((n - a) / p).cast("int")
        tail = F.slice(F.flatten(F.array_repeat(F.slice(w, (a + 1).cast("int"), p.cast("int")), times)), F.lit(1), (n - a).cast("int"))
        return F.when(n > 0, F.array_join(F.concat(F.slice(w, F.lit(1), a.cast("int")), tail), " ")).otherwise(text)

    # Bound as a variable, so that the words are cut once.
    return F.when(h % 10 == 0, F.transform(F.array(words), loop)[0]).otherwise(text)


def looped_documents(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", looped(F.col("doc_id"), text_or_empty()).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    line = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", *[r[f].cast("string") for f in ("start", "length", "period")]), F.lit("\n"))), "")
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("fewer"))))
    rows = found.select("doc_id", "runs", "collapsed", line.alias("line"), best.alias("best"))
    start, length, period = -F.col("best.before"), F.col("best.length"), -F.col("best.fewer")
    return rows.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), start.alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"), F.sha2("line", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))
