"""Texts that repeat are scored, split and counted once, and count for all their rows."""

import pytest
from frames import plan
from pyspark.sql import functions as F

from chorale.functions.sentiment import add_sentiment, score_by_lexicon_join, score_once
from chorale.operators import retrieval

TEXTS = ["best best bad", "worst", "Worst", "", None, "so so", "love it", "bad trash"]


@pytest.fixture(scope="module")
def comments(spark):
    rows = [(str(i) if i % 5 else None, TEXTS[i % len(TEXTS)]) for i in range(40)]
    return spark.createDataFrame(rows, "comment_id string, text string").repartition(3)


def listed(df):
    return sorted(map(str, df.collect()))


def test_labels_are_those_of_the_expression(spark, comments):
    plain = add_sentiment(comments).select("comment_id", "text", "sentiment")
    assert listed(score_once(comments)) == listed(plain)
    calls = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def label(text):
        calls.add(1)
        return text[:1]

    score_once(comments, label).collect()
    assert calls.value == len(set(TEXTS) - {None})


def test_the_lexicon_join_splits_each_text_once(spark, comments):
    lexicon = spark.createDataFrame([("best", 1), ("love", 1), ("bad", -1), ("trash", -1), ("worst", -1)], "word string, weight int")
    scored = score_by_lexicon_join(comments, lexicon)
    assert listed(scored) == listed(add_sentiment(comments).select("comment_id", "sentiment"))
    below = plan(scored).split("Generate explode", 1)[1]
    assert "HashAggregate(keys=[_text" in below


def test_terms_of_counted_texts(comments):
    negative = lambda df: add_sentiment(df).filter(F.col("sentiment") == "negative")
    plain = retrieval.top_terms(negative(comments), 20).collect()
    once = retrieval.top_terms(negative(retrieval.counted_texts(comments)), 20, copies="copies")
    assert once.collect() == plain and plain[0]["occurrences"] == 10
    filters = [line for line in plan(once).split("HashAggregate(keys=[text")[-1].splitlines() if "Filter" in line]
    assert not any("arrays_overlap" in line for line in filters)
