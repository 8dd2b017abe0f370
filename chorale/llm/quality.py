"""Quality rules: document statistics, base rules, and gradient-boosted trees on the statistics.

Statistics and verdict are taken in one pass over Arrow batches, without a shuffle.  The trees are fitted on a bounded
sample of labelled rows (``sample_rows``, a parameter; the rest of the labels is not needed for it), flattened
into numpy node arrays, and score all documents of a batch level by level.  Constrained features act in one direction
only: a split that would turn the direction round is not made, and the bounds of a split pass to its children.

Defined results: a null text has no words and fails the base rules; a null id is kept as it is; repeated rows are
judged each; an empty table gives no rows; with no labels, or labels of one kind, the model keeps everything.
Very long texts are read whole.  Columns other than id and text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorale.llm.common import small_batches

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"

#: Feature -> direction in which it may move the score (0: free).
FEATURES = {
    "mean_word": 0, "symbols_per_word": -1, "dup_line_share": -1, "repeat_share": -1, "upper_share": -1,
    "exclaim_per_word": -1, "distinct_share": 0, "sentence_end_share": 0, "words_per_line": 0, "log_words": 0,
    "digit_word_share": 0, "long_word_share": 0,
}
LEAST_ODDS = 0.0
STAT_NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
STATS = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"


def words_of(text: str) -> list[str]:
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def repeat_words(codes: np.ndarray, kinds: int) -> int:
    """Words that stand in a 3-word window found twice or more."""
    if len(codes) < 4:
        return 0
    if kinds < 2_000_000:
        key = (codes[:-2] * kinds + codes[1:-1]) * kinds + codes[2:]
    else:
        pair = np.unique(codes[:-1] * kinds + codes[1:], return_inverse=True)[1]
        key = pair[:-1] * kinds + codes[2:]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    at = np.zeros(len(codes), dtype=bool)
    at[:-2] |= twice
    at[1:-1] |= twice
    at[2:] |= twice
    return int(at.sum())


def statistics(text: str | None) -> tuple:
    text = text or ""
    words = words_of(text)
    n, kinds = len(words), {}
    codes = np.fromiter((kinds.setdefault(w, len(kinds)) for w in words), dtype=np.int64, count=n)
    lines, seen, n_lines, n_dup = text.split("\n"), set(), 0, 0
    for line in lines:
        if line.strip(" \t\n\x0b\x0c\r"):
            n_lines += 1
            n_dup += line in seen
            seen.add(line)
    chars, symbols, repeats = sum(map(len, words)), sum(text.count(c) for c in SYMBOLS), repeat_words(codes, len(kinds))
    per = 1.0 / max(n, 1)
    times = np.bincount(codes, minlength=len(kinds)) if n else np.zeros(0, dtype=np.int64)
    upper = digits = long = ends = 0
    for w, k in zip(kinds, times.tolist()):  # each different word once
        if len(w) > 1 and w.isupper():
            upper += k
        if w[-1] in ".,;:!?":
            ends += k
        if len(w) > 12:
            long += k
        if "0" <= w[0] <= "9":
            digits += k
    return (n, chars, symbols, n_dup, repeats,
            chars * per, symbols * per, n_dup / max(n_lines, 1), repeats * per, upper * per,
            text.count("!") * per, len(kinds) * per, ends * per, n / max(n_lines, 1), float(np.log1p(n)),
            digits * per, long * per)


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the counts of the base rules and the features of the model."""
    small_batches(docs.sparkSession)
    ids = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = dict(ids.dtypes)["doc_id"]
    return ids.mapInArrow(_with_statistics, f"doc_id {kind}, {STATS}, " + ", ".join(f"{f} double" for f in FEATURES))


def _table(texts: pa.Array) -> tuple[list[pa.Array], np.ndarray]:
    """The five counts as Arrow arrays, and the matrix of features."""
    rows = [statistics(t) for t in texts.to_pylist()]
    columns = list(zip(*rows)) if rows else [()] * (len(STAT_NAMES) + len(FEATURES))
    counts = [pa.array(c, pa.int64()) for c in columns[: len(STAT_NAMES)]]
    return counts, np.array(columns[len(STAT_NAMES):], dtype=float).T.reshape(len(rows), len(FEATURES))


def _with_statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        counts, x = _table(b.column(1))
        yield pa.RecordBatch.from_arrays([b.column(0), *counts, *map(pa.array, x.T)], ["doc_id", *STAT_NAMES, *FEATURES])


def failed(n_words: np.ndarray, n_repeat_words: np.ndarray) -> np.ndarray:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)


@dataclass
class Trees:
    """All trees in one list of nodes.  A leaf points to itself, so every row can take the same number of steps."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log odds of good quality, for all rows at once."""
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            out += self.value[at]
        return out


def fit_trees(
    x: np.ndarray, y: np.ndarray, directions: list[int], n_trees: int = 60, depth: int = 4, rate: float = 0.15,
    bins: int = 64, min_rows: int = 10, ridge: float = 1.0,
) -> Trees:
    """Gradient boosting of the logistic loss on binned features, with monotonic constraints."""
    nodes: list[list] = []  # feature, threshold, left, right, value
    roots: list[int] = []
    good = float(y.mean()) if len(y) else 1.0
    base = float(np.log(good / (1 - good))) if 0 < good < 1 else (20.0 if good else -20.0)
    if 0 < good < 1:
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T)], axis=1)
        margin = np.full(len(y), base)

        def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, level: int, low: float, high: float) -> int:
            at = len(nodes)
            value = float(np.clip(-g[rows].sum() / (h[rows].sum() + ridge), low, high))
            nodes.append([0, np.inf, at, at, rate * value])
            if level == depth or len(rows) < 2 * min_rows:
                return at
            total_g, total_h, best = g[rows].sum(), h[rows].sum(), (1e-6, 0, 0, 0.0, 0.0)
            for f, direction in enumerate(directions):
                if not len(cuts[f]):
                    continue
                b = binned[rows, f]
                k = len(cuts[f]) + 1
                gl, hl, nl = (np.cumsum(np.bincount(b, weights=w, minlength=k))[:-1] for w in (g[rows], h[rows], None))
                gr, hr, nr = total_g - gl, total_h - hl, len(rows) - nl
                vl, vr = np.clip(-gl / (hl + ridge), low, high), np.clip(-gr / (hr + ridge), low, high)
                # The loss removed by two leaves with these (bounded) values, against one leaf.
                gain = -(gl * vl + 0.5 * (hl + ridge) * vl**2) - (gr * vr + 0.5 * (hr + ridge) * vr**2)
                gain += total_g * value + 0.5 * (total_h + ridge) * value**2
                gain[(nl < min_rows) | (nr < min_rows) | (direction * (vr - vl) < 0)] = -np.inf
                i = int(np.argmax(gain))
                if gain[i] > best[0]:
                    best = (float(gain[i]), f, i, float(vl[i]), float(vr[i]))
            gain, f, i, vl, vr = best
            if gain <= 1e-6:
                return at
            middle, direction = (vl + vr) / 2, directions[f]
            below = binned[rows, f] <= i
            lo, hi = (low, middle) if direction > 0 else (middle, high) if direction < 0 else (low, high)
            left = grow(rows[below], g, h, level + 1, lo, hi)
            lo, hi = (middle, high) if direction > 0 else (low, middle) if direction < 0 else (low, high)
            right = grow(rows[~below], g, h, level + 1, lo, hi)
            nodes[at] = [f, float(cuts[f][i]), left, right, 0.0]
            return at

        for _ in range(n_trees):
            p = 1 / (1 + np.exp(-margin))
            start = len(nodes)
            roots.append(grow(np.arange(len(y)), p - y, p * (1 - p), 0, -4.0, 4.0))
            tree = _flat([start], nodes, depth, 0.0)
            margin += tree.score(x)
    return _flat(roots, nodes, depth, base)


def _flat(roots: list[int], nodes: list[list], depth: int, base: float) -> Trees:
    f, t, left, right, v = zip(*nodes) if nodes else ((), (), (), (), ())
    return Trees(np.array(roots, dtype=np.int64), np.array(f, dtype=np.int64), np.array(t), np.array(left, dtype=np.int64),
                 np.array(right, dtype=np.int64), np.array(v), depth, base)


def fit_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = 20_000, seed: int = 5
) -> Trees:
    """Trees fitted on at most ``sample_rows`` labelled documents, chosen by a seeded hash of their ids.

    Documents that fail the base rules are left out of the fit: those rules decide about them.
    """
    order = F.xxhash64(F.lit(seed), "label_id")
    marked = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").select(
        F.col("doc_id").alias("label_id"), F.col("quality").cast("double").alias("good"))
    marked = marked.orderBy(order, "label_id", "good").limit(sample_rows)
    # At most ``sample_rows`` narrow rows are broadcast; only texts of labelled documents are looked at.
    of = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(
        F.broadcast(marked), F.col("id") == F.col("label_id")).select(F.struct("label_id", "good").alias("label"), "text")
    rows = document_statistics(of, "label", "text").select("doc_id.*", *STAT_NAMES, *FEATURES)
    sample = rows.orderBy(order, *rows.columns).limit(sample_rows).toPandas()
    sample = sample[~failed(sample["n_words"].to_numpy(), sample["n_repeat_words"].to_numpy())]
    return fit_trees(sample[list(FEATURES)].to_numpy(float), sample["good"].to_numpy(float), list(FEATURES.values()))


def _verdicts(trees: Trees, least_odds: float, counts: list[pa.Array], x: np.ndarray) -> tuple:
    bad, odds = failed(counts[0].to_numpy(), counts[4].to_numpy()), trees.score(x)
    return bad, odds, ~bad & (odds >= least_odds)


def judge(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = 20_000,
    least_odds: float = LEAST_ODDS,
) -> DataFrame:
    """doc_id, the base counts, base_failed, quality_score (log odds), kept; one row per row of ``docs``."""
    trees = fit_quality(docs, labels, id_col, text_col, sample_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts, x = _table(b.column(1))
            verdicts = map(pa.array, _verdicts(trees, least_odds, counts, x))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *counts, *verdicts], ["doc_id", *STAT_NAMES, "base_failed", "quality_score", "kept"])

    ids = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = dict(ids.dtypes)["doc_id"]
    return ids.mapInArrow(run, f"doc_id {kind}, {STATS}, base_failed boolean, quality_score double, kept boolean")


def keep_good(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = 20_000,
    least_odds: float = LEAST_ODDS,
) -> DataFrame:
    """``docs`` without the rows that are rejected, all columns as they were."""
    trees, at = fit_quality(docs, labels, id_col, text_col, sample_rows), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(_verdicts(trees, least_odds, *_table(b.column(at)))[2]))

    return docs.mapInArrow(run, docs.schema)
