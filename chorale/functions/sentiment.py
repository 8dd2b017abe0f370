"""Comment sentiment: ``Column -> Column`` scorers that return positive / negative / neutral.

The word-count rule below matches the interface of a hosted sentiment model (one label per text, NULL
for NULL) but not its judgement.  Any other ``Callable[[Column], Column]`` can take its place, see
:func:`model_scorer`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chorale.functions.text import tokens
from chorale.session import materialise

Scorer = Callable[[Column], Column]

# The default word lists.
POSITIVE_WORDS = ["best", "good", "great", "love", "excellent", "amazing", "awesome", "helpful"]
NEGATIVE_WORDS = [
    "worst", "bad", "trash", "scum", "idiot", "clown", "worthless", "moron", "pathetic", "loser",
    "stupid", "disgusting",
]

# Labels by the sign of (positive - negative) tokens.
_LABELS = ("negative", "neutral", "positive")


def _label(text: Column, balance: Column) -> Column:
    label = F.element_at(F.array(*[F.lit(x) for x in _LABELS]), F.signum(balance).cast("int") + 2)
    return F.when(text.isNotNull(), label)


def lexicon_scorer(
    positive: Sequence[str] = POSITIVE_WORDS, negative: Sequence[str] = NEGATIVE_WORDS
) -> Scorer:
    """More positive than negative tokens: positive; fewer: negative; else neutral.

    The token array is bound to a lambda variable, so a text is split once.  ``arrays_overlap`` hashes
    the lexicon once per row, so texts without any listed word (most) skip the two counting passes.
    """
    pos, neg = list(positive), list(negative)

    def balance(toks: Column) -> Column:
        listed = F.arrays_overlap(toks, F.array(*[F.lit(w) for w in pos + neg]))
        count = F.size(F.filter(toks, lambda t: t.isin(pos))) - F.size(F.filter(toks, lambda t: t.isin(neg)))
        return F.when(listed, count).otherwise(F.lit(0))

    return lambda text: _label(text, F.transform(F.array(tokens(text)), balance)[0])


def model_scorer(predict: Callable[[pd.Series], pd.Series]) -> Scorer:
    """Plug in a model: ``predict`` maps a batch of non-NULL texts to labels, Arrow batch by batch."""

    @F.pandas_udf("string")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out = pd.Series([None] * len(texts), index=texts.index, dtype=object)
            present = texts.notna()
            if present.any():
                out[present] = list(predict(texts[present]))
            yield out

    return lambda text: scored(text)


#: Bits of the filter per word of the lexicon, and at most: a fuller filter lets more words through, none is lost.
BITS_PER_WORD, MOST_BITS = 16, 1 << 24


def word_filter(words: DataFrame) -> Column:
    """A bitmap of the hashes of ``word`` as ``array<bigint>``: a scalar of two bytes a word, two megabytes at most.

    One row per 64 bits is made by an aggregate that is combined map-side; all of them are one array of known length.
    """
    n = words.count()
    bits = min(MOST_BITS, 64 << max(0, (n * BITS_PER_WORD // 64)).bit_length())
    at = F.pmod(F.xxhash64("word"), F.lit(bits))
    set_bits = words.select(F.floor(at / 64).cast("int").alias("slot"), F.call_function(
        "shiftleft", F.lit(1).cast("bigint"), (at % 64).cast("int")).alias("bit"))
    every = words.sparkSession.range(bits // 64).select(F.col("id").cast("int").alias("slot"), F.lit(0).cast("bigint").alias("bit"))
    slots = set_bits.unionByName(every).groupBy("slot").agg(F.bit_or("bit").alias("bits"))
    return slots.agg(F.transform(F.array_sort(F.collect_list(F.struct("slot", "bits"))), lambda s: s["bits"]).alias("f")).scalar()


def may_hold(filter_bits: Column, word: Column) -> Column:
    """False only for words that are not in the filter."""
    at = F.pmod(F.xxhash64(word), F.size(filter_bits).cast("bigint") * 64)
    return F.getbit(F.get(filter_bits, F.shiftright(at, 6).cast("int")), at.bitwiseAND(F.lit(63).cast("bigint")).cast("int")) == 1


def score_by_lexicon_join(comments: DataFrame, lexicon: DataFrame) -> DataFrame:
    """The same rule for long or weighted lists: ``comment_id, sentiment`` from ``lexicon(word, weight)``.

    One row per row of ``comments``, whatever its id: a text is scored under a hash of its own, and rows
    find their score by it.  Copies of a text are combined before it is split, so each text is split once.  A bitmap of the
    lexicon sorts words out inside the task, so only words that are listed, and about one in a hundred others, leave
    it and meet the lexicon.  The lexicon is written first, so Spark knows its size and broadcasts it only below its
    threshold.  Words of the lexicon must be unique.
    """
    listed = materialise(lexicon.select("word", "weight"), "lexicon")
    keyed = comments.select("comment_id", "text", F.xxhash64("text").alias("_text"))
    # Words are sorted out as rows, by compiled code: a lambda over the array would be interpreted for each word.
    texts = keyed.filter(F.col("text").isNotNull()).select("_text", "text").distinct()
    words = texts.select("_text", F.explode(tokens(F.col("text"))).alias("word"))
    hits = words.filter(may_hold(word_filter(listed), F.col("word"))).join(listed, "word")
    balance = hits.groupBy("_text").agg(F.sum("weight").alias("_balance"))
    rows = keyed.select("comment_id", "_text", F.when(F.col("text").isNotNull(), F.lit("")).alias("_known"))
    scored = rows.join(balance, "_text", "left")
    label = _label(F.col("_known"), F.coalesce("_balance", F.lit(0)))
    return scored.select("comment_id", label.alias("sentiment"))


def add_sentiment(df: DataFrame, scorer: Scorer | None = None, text: str = "text") -> DataFrame:
    return df.withColumn("sentiment", (scorer or lexicon_scorer())(F.col(text)))


def score_once(df: DataFrame, scorer: Scorer | None = None, text: str = "text") -> DataFrame:
    """``add_sentiment`` for texts that repeat: each different text is scored once, and rows find its label by a digest of the text.

    Copies are combined map-side, so what is shuffled are the different texts; the rows travel without theirs if it is not asked for.
    """
    labels = add_sentiment(df.select(text).filter(F.col(text).isNotNull()).distinct(), scorer, text)
    labels = materialise(labels.select(F.unhex(F.sha2(text, 256)).alias("_text"), "sentiment"), "labels")
    return df.withColumn("_text", F.unhex(F.sha2(text, 256))).join(labels, "_text", "left").drop("_text")
