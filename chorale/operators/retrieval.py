"""Finding comments by their words: filters, term counts and ranked retrieval with citations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chorale.functions.text import holds_any, search_words, words
from chorale.operators.channels import for_channel
from chorale.session import materialise

# Words too common to be a complaint, and phrases that ask for more content.
STOP_WORDS = [
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "from", "had", "has", "have", "he", "her",
    "his", "i", "in", "is", "it", "its", "me", "my", "not", "of", "on", "or", "our", "she", "so", "that",
    "the", "their", "them", "they", "this", "to", "was", "we", "were", "with", "you", "your",
]
FOLLOW_UP_PHRASES = [
    "part two", "part 2", "next video", "follow up", "follow-up", "more videos", "make a video", "tutorial on",
    "please cover", "can you explain", "would love", "want more", "another one",
]

CITATION = ["comment_id", "channel_handle", "title", "video_url", "text"]


def _holds_any_token(text: Column, terms: Sequence[str]) -> Column:
    """Any of the words as a whole token.  A plain substring search comes first: it is several times
    cheaper than tokenising and rules out most rows."""
    listed = F.array(*[F.lit(t) for t in terms])
    return holds_any(text, terms) & F.arrays_overlap(words(text), listed)


def comments_mentioning(silver: DataFrame, terms: Sequence[str], channel: str | None = None) -> DataFrame:
    """Comments that hold any of the given words as a whole word, with title and link."""
    return for_channel(silver, channel).filter(_holds_any_token(F.col("text"), search_words(terms))).select(*CITATION)


def follow_up_requests(
    silver: DataFrame, phrases: Sequence[str] = FOLLOW_UP_PHRASES, channel: str | None = None
) -> DataFrame:
    """Comments that hold one of the phrases, in any case."""
    return for_channel(silver, channel).filter(holds_any(F.col("text"), phrases)).select(*CITATION)


def counted_texts(comments: DataFrame) -> DataFrame:
    """``text, copies``: each different text and how many comments have it.

    ``text`` is bound to the count, so that no filter on what is made of it goes before the grouping, to every comment.
    """
    counted = comments.groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    return counted.select(F.when(F.col("copies") > 0, F.col("text")).alias("text"), "copies")


def term_counts(comments: DataFrame, stop_words: Sequence[str] = STOP_WORDS, copies: str | None = None) -> DataFrame:
    """``term, occurrences`` without stop words; ``copies``: the column that says for how many comments a row stands.

    Counts are combined map-side, so a term that is in every comment costs one row per task.
    """
    n = F.lit(1).cast("bigint") if copies is None else F.col(copies)
    kept = comments.select(n.alias("n"), F.explode(words(F.col("text"))).alias("term")).filter(~F.col("term").isin(list(stop_words)))
    return kept.groupBy("term").agg(F.sum("n").alias("occurrences"))


def top_terms(
    comments: DataFrame, k: int, stop_words: Sequence[str] = STOP_WORDS, channel: str | None = None, copies: str | None = None
) -> DataFrame:
    return term_counts(for_channel(comments, channel), stop_words, copies).orderBy(F.col("occurrences").desc(), "term").limit(k)


def _occurrences(toks: Column, word: str) -> Column:
    return F.size(toks) - F.size(F.array_remove(toks, word))


def bm25_part(tf: Column, length: Column, df: Column, n: Column, avg_len: Column, k1: float, b: float) -> Column:
    """Contribution of one query word to the score of one document."""
    idf = F.log(1 + (n - df + 0.5) / (df + 0.5))
    return idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / avg_len))


def bm25_scores(
    comments: DataFrame, query: Sequence[str], text: str = "text", k1: float = 1.2, b: float = 0.75, copies: str | None = None
) -> DataFrame:
    """``comments`` with ``score``: Okapi BM25 (Robertson and Zaragoza 2009) of the query words.

    Only rows with at least one query word are returned.  Term counts and lengths are computed inside
    each row, so texts are never shuffled: the corpus needs one aggregate of a single row (document
    count, mean length, document frequency per query word), read back as a scalar subquery.  Both scans
    read the texts; for many queries over the same comments use the index in
    :mod:`chorale.operators.text_index`.  ``copies``: the column that says for how many comments a row stands.
    """
    terms = search_words(query)
    # Binding the token array to a lambda variable keeps tokenising to once per row.
    counted = F.transform(
        F.array(words(F.col(text))),
        lambda toks: F.struct(
            F.size(toks).alias("len"),
            F.array(*[_occurrences(toks, w) for w in terms]).alias("tf"),
        ),
    )[0]
    # The statistics ask for lengths and presence only, which compiled code finds in a column of the words.
    rows_of = F.lit(1).cast("bigint") if copies is None else F.col(copies)
    docs = comments.select(words(F.col(text)).alias("_words"), rows_of.alias("_n"))
    counted_if = lambda c: F.coalesce(F.sum(F.when(c, F.col("_n"))), F.lit(0)).cast("double")
    stats = docs.agg(
        F.struct(
            counted_if(F.lit(True)).alias("n"),
            F.try_divide(F.sum(F.array_size("_words") * F.col("_n")).cast("double"), counted_if(F.col("_words").isNotNull())).alias("avg_len"),
            *[counted_if(F.array_contains("_words", w)).alias(f"df{i}") for i, w in enumerate(terms)],
        ).alias("s")
    )
    rows = comments.filter(holds_any(F.col(text), terms)).withColumn("_d", counted)
    rows = rows.filter(F.exists("_d.tf", lambda n: n > 0)).withColumn("_s", stats.scalar())
    score = reduce(lambda a, c: a + c, [
        bm25_part(F.col("_d.tf")[i], F.col("_d.len"), F.col(f"_s.df{i}"), F.col("_s.n"), F.col("_s.avg_len"), k1, b)
        for i in range(len(terms))
    ])
    return rows.withColumn("score", score).drop("_d", "_s")


def bm25_top_k(
    comments: DataFrame, query: Sequence[str], k: int, channel: str | None = None, repeated: bool = False, **options
) -> DataFrame:
    """The ``k`` best comments with citation; scores rounded to 6 digits, ties by ``comment_id``.

    With ``channel`` the ranking and its statistics are those of that channel alone.  ``repeated`` is for texts that repeat: each
    different text is shuffled, split and scored once, and comments without theirs find its score by a digest.  Only the
    ``k`` best get it back.
    """
    comments = for_channel(comments, channel)
    best_first = [F.col("score").desc(), F.col("comment_id")]
    if not repeated:
        scored = bm25_scores(comments, query, **options).select(*CITATION, F.round("score", 6).alias("score"))
        return scored.orderBy(*best_first).limit(k)
    text = options.pop("text", "text")
    digest = F.unhex(F.sha2(text, 256)).alias("_text")
    texts = materialise(counted_texts(comments.select(F.col(text).alias("text"))), "counted-texts")
    found = bm25_scores(texts, query, copies="copies", **options).select(
        F.unhex(F.sha2("text", 256)).alias("_text"), F.col("text").alias("_found"), F.round("score", 6).alias("score"))
    found = materialise(found, "bm25-texts")
    # A text that holds no search word has no score, and its rows need no digest.
    rows = comments.filter(holds_any(F.col(text), search_words(query))).select(*[c for c in CITATION if c != text], digest)
    best = rows.join(found.select("_text", "score"), "_text").orderBy(*best_first).limit(k)
    return best.join(found.select("_text", F.col("_found").alias(text)), "_text").select(*CITATION, "score").orderBy(*best_first)
