"""Every term of a text counts for its fingerprint, however many there are."""

import random

from pyspark.sql import functions as F
from test_imatch import plain, rows, same

from chorale.llm import imatch

WORDS = [f"w{i}" for i in range(9_000)]


def corpus(seed=5):
    """Short and long texts of some words in common, each word in a few texts, and near copies and equal rows."""
    r = random.Random(seed)
    texts = [" ".join(r.sample(WORDS, n)) for n in (5, 40, 70, 300, 1200) for _ in range(30)]
    texts += [t + " common" for t in texts[:60]] + [texts[7], "", None, "Alone, einzig!"]
    return [(i // 2 * 2 if i % 9 else None, t) for i, t in enumerate(texts)]


def test_every_term_of_a_long_text_counts(spark):
    """A text of 300 words and versions of it with one word less: all have fingerprints of their own."""
    r = random.Random(1)
    base = r.sample(WORDS, 300)
    versions = [base, *[base[:i] + base[i + 1:] for i in range(300)]]
    docs = [(i, " ".join(v)) for i, v in enumerate(versions)]
    words = spark.createDataFrame([(w,) for w in base], "w string").select(F.xxhash64(F.lit(imatch.SEED), "w").alias("term"))
    prints = imatch.fingerprints(spark.createDataFrame(docs, "doc_id bigint, text string"), words=words)
    assert prints.select("fingerprint").distinct().count() == len(versions)


def test_long_and_short_texts_as_the_plain_version(spark):
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    want = plain(docs)
    same(rows(imatch.compare_next(df)), want)
    # A lexicon that is given asks for all terms, and finds the same.
    same(rows(imatch.compare_next(df, words=imatch.lexicon(df))), want)
    prints = sorted([(d, f) for d, _, _, f, *_ in want], key=repr)
    assert rows(imatch.fingerprints(df)) == prints and rows(imatch.fingerprints(df, words=imatch.lexicon(df))) == prints


def test_terms_are_counted_in_all_texts(spark):
    """A word of long texts alone, on any level of the hash, is in the lexicon with all documents that hold it."""
    docs = [(i, " ".join(WORDS[i * 100:i * 100 + 100]) + " both") for i in range(45)] + [(50, WORDS[3] + " " + WORDS[203])]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    found = {r["term"]: r["n_docs"] for r in imatch.lexicon(df, max_share=1.0).collect()}
    term = lambda w: df.select(F.xxhash64(F.lit(imatch.SEED), F.lit(w))).first()[0]
    assert found == {term("both"): 45, term(WORDS[3]): 2, term(WORDS[203]): 2}
