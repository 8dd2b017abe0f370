"""Mixing sources to target weights, fitted word by word.

1. *Targets*: sources in code point order (null last) weigh ``weights`` in turn and share ``share`` of all words.
   No target passes ``most`` times its source; the excess goes to the others by weight.  That is water filling:
   target = min(most * size, level * weight), where the level comes from a running sum over the sources in the order
   in which they fill up.
2. *Length histogram*: documents per (source, size), combined before the shuffle.  No text and no id is in it.
3. *Fit*: a source takes whole rounds of its documents (``floor(target / size)``).  The rest is a subset-sum over the
   remaining copies: every length first gives the same share of its documents, the largest fitting
   lengths then fill up until what is left is below ``DP_SPAN``, and a bounded knapsack (numpy, one pass per length,
   fewest copies used of each) finds the largest reachable sum not above it.  A group of this step is one source's
   histogram, so its size is the number of different lengths.
4. *Choice*: which documents of a length are taken is decided by a seeded hash.  Documents of a (source, size) are
   dealt into slices by hash with about ``SLICE`` documents each; slices below the cut are whole, and only the slice at
   the cut is ranked.  No window holds more than a slice, however hot a source or a length is.

Defined results: a null text has size 0 and is never taken; a null source is a source of its own, the last one; an empty
table gives no rows.  Repeated rows are separate documents: equal rows rank next to each other in an order that does
not show in the result.  Only id, text and source are read; other columns may have any names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chorale.llm.common import WORD, one_of_equal, row_key, text_or_empty, wrapped
from chorale.session import materialise

WEIGHTS = (5, 2, 1)
SHARE, MOST = 1.5, 2
SEED = 20
SLICE = 1000
DP_SPAN = 1 << 15


def word_count(text: str) -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """source, size per source -> source, source_size, target.  The windows run over one narrow row per source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.col("at") - 1) % len(weights) + 1).cast("int"))
    s = sizes.withColumn("at", F.row_number().over(by_name)).withColumn("weight", w)
    # In the order in which they fill: the level at which a source is full is most * size / weight.
    s = s.withColumn("full_at", F.lit(float(most)) * F.col("source_size") / F.col("weight"))
    fill = Window.orderBy("full_at", "at")
    before, after = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    total = F.sum("source_size").over(everything) * F.lit(float(share))
    full = F.coalesce(F.sum("source_size").over(before), F.lit(0)) * F.lit(float(most))
    s = s.withColumn("level", (total - full) / F.sum("weight").over(after))
    # The first source that the level does not fill gives the level of all that follow.
    level = F.min(F.when(F.col("level") < F.col("full_at"), F.struct("full_at", "at", "level"))).over(everything)["level"]
    cap = F.lit(float(most)) * F.col("source_size")
    s = s.withColumn("final", level)
    target = F.when(F.col("final").isNull(), cap).otherwise(F.least(cap, F.col("final") * F.col("weight")))
    return s.select("source", "source_size", target.alias("target"))


def _knapsack(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How often to use each length, at most ``counts`` times, for the largest sum not above ``budget``.

    ``first[s]`` is the length that first made the sum s reachable and ``left[s]`` how many of it were used on the way;
    a sum made reachable by a length extends one that shorter lists of lengths reach, so the way back is unique.
    """
    used = np.zeros(len(lengths), dtype=np.int64)
    if budget <= 0 or not len(lengths):
        return used
    first = np.full(budget + 1, -1, dtype=np.int64)
    reach = np.zeros(budget + 1, dtype=bool)
    reach[0] = True
    for i, (n, c) in enumerate(zip(lengths.tolist(), counts.tolist())):
        c, frontier = min(c, budget // n), np.flatnonzero(reach)
        for _ in range(c):  # sums with one more of this length; each sum enters once, so the loop ends early
            frontier = frontier[frontier + n <= budget] + n
            frontier = frontier[~reach[frontier]]
            if not len(frontier):
                break
            reach[frontier] = True
            first[frontier] = i
        if reach[budget]:
            break
    s = int(np.flatnonzero(reach)[-1])
    while s:
        i = first[s]
        used[i] += 1
        s -= int(lengths[i])
    return used


def fit_source(lengths: np.ndarray, counts: np.ndarray, target: int, most: int) -> tuple[int, np.ndarray]:
    """(rounds, extra): every document is taken ``rounds`` times and ``extra[l]`` of each length once more."""
    size = int((lengths * counts).sum())
    if size == 0 or target <= 0:
        return 0, np.zeros(len(lengths), dtype=np.int64)
    rounds = min(target // size, most)
    rest = target - rounds * size
    if rounds >= most or rest <= 0:
        return int(rounds), np.zeros(len(lengths), dtype=np.int64)
    extra = (counts * (rest / size)).astype(np.int64)
    rest -= int((extra * lengths).sum())
    for i in np.argsort(-lengths, kind="stable"):  # the longest that fit, until the knapsack can hold the rest
        if rest < DP_SPAN:
            break
        k = min(int(counts[i] - extra[i]), (rest - DP_SPAN // 2) // int(lengths[i]))
        if k > 0:
            extra[i] += k
            rest -= k * int(lengths[i])
    free = counts - extra
    if rest > 4 * DP_SPAN:  # only documents longer than that are left: whole ones while they fit
        for i in np.argsort(-lengths, kind="stable"):
            k = min(int(free[i]), rest // int(lengths[i]))
            extra[i], free[i], rest = extra[i] + k, free[i] - k, rest - k * int(lengths[i])
    usable = np.flatnonzero((free > 0) & (lengths <= rest))
    usable = usable[np.argsort(lengths[usable], kind="stable")]
    extra[usable] += _knapsack(lengths[usable], free[usable], min(int(rest), 4 * DP_SPAN))
    return int(rounds), extra


def _fit(most: int):
    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("size", ignore_index=True)
        lengths, counts = rows["size"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)
        rounds, extra = fit_source(lengths, counts, int(rows["target"].iloc[0]), most)
        return pd.DataFrame({"source": rows["source"], "size": lengths, "n": counts, "rounds": rounds, "extra": extra})

    return fit


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = SEED,
) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken; one row per row of ``docs``."""
    rows = materialise(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(text_col).alias("size"),
        F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).alias("draw")), "mix-sizes")
    lengths = rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    sources = lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = materialise(source_targets(sources, weights, share, most), "mix-targets").select(
        F.col("source").alias("of"), "source_size", "target")
    mine = F.col("source").eqNullSafe(F.col("of"))
    filled = lengths.filter("size > 0").join(targets, mine).select("source", "size", "n", "target")
    plan = filled.groupBy("source").applyInPandas(_fit(most), "source string, size bigint, n bigint, rounds bigint, extra bigint")
    plan = materialise(plan.withColumn("slices", F.ceil(F.col("n") / F.lit(SLICE)).cast("bigint")), "mix-plan")

    # A draw below 2^63 as a fraction of it names the slice; a slice lies before another if all its draws do.
    keyed = rows.alias("r").join(
        plan.select(F.col("source").alias("ps"), F.col("size").alias("pz"), "rounds", "extra", "slices"),
        F.col("r.source").eqNullSafe(F.col("ps")) & (F.col("r.size") == F.col("pz"))).select("r.*", "rounds", "extra", "slices")
    fraction = F.col("draw").bitwiseAND(F.lit((1 << 53) - 1)) / F.lit(float(1 << 53))
    keyed = keyed.withColumn("slice", F.floor(fraction * F.col("slices")))
    counts = keyed.groupBy("source", "size", "extra", "slice").agg(F.count(F.lit(1)).alias("k"))
    running = Window.partitionBy("source", "size").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    passed = F.coalesce(F.sum("k").over(running), F.lit(0))
    # The cut is the first slice that holds more than is still to be taken; without one, all are taken.
    cuts = counts.withColumn("passed", passed).filter("passed + k > extra").groupBy("source", "size").agg(
        F.min(F.struct("slice", (F.col("extra") - F.col("passed")).alias("part"))).alias("cut"))
    cuts = materialise(cuts.select(F.col("source").alias("cs"), F.col("size").alias("cz"), "cut"), "mix-cuts")
    at = keyed.join(cuts, F.col("source").eqNullSafe(F.col("cs")) & (F.col("size") == F.col("cz")), "left")
    columns = ["doc_id", "source", "size", "rounds", "once"]
    ranked = Window.partitionBy("source", "size").orderBy("draw", "doc_id")
    boundary = at.filter("slice = cut.slice AND cut.part > 0").withColumn(
        "once", (F.row_number().over(ranked) <= F.col("cut.part")).cast("bigint"))
    rest = at.filter("cut IS NULL OR slice <> cut.slice OR cut.part = 0").withColumn(
        "once", F.coalesce(F.col("slice") < F.col("cut.slice"), F.lit(True)).cast("bigint"))
    none = F.lit(0).cast("bigint")
    empty = rows.filter("size = 0").withColumn("rounds", none).withColumn("once", none)
    chosen = rest.select(*columns).unionByName(boundary.select(*columns)).unionByName(empty.select(*columns))
    copies = F.col("rounds") + F.col("once")
    return chosen.join(targets, mine).select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def take_mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """``docs`` as the mix takes them: rows taken twice occur twice, others once or not at all; same columns."""
    mixed = mix(docs.select(F.struct(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("row")).alias("who"),
                            F.col(text_col).alias("text"), F.col(source_col).alias("source")), "who", "text", "source", **how)
    taken = materialise(mixed.groupBy(F.col("doc_id.id").alias("taken_id"), F.col("doc_id.row").alias("taken_row")).agg(
        F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("n_rows")).filter("copies > 0"), "mix-taken")
    joined = wrapped(docs, id_col, text_col).join(
        taken.hint("merge"), F.col("own_id").eqNullSafe(F.col("taken_id")) & (F.col("own_row") == F.col("taken_row")))
    joined = joined.select("own_id", "own_row", "doc", "copies", "n_rows")
    # Equal rows are one document here: it comes out as often as all of them are taken.
    equal = one_of_equal(joined.filter("n_rows > 1"))
    out = joined.filter("n_rows = 1").unionByName(equal)
    return out.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("doc.*")
