"""Replies and their parents meet on narrow rows."""

from frames import plan
from pyspark.sql import functions as F

from chorale.operators import joins

TEXTS = ["Alpha beta", "", None, "beta, beta gamma", "  "]


def listed(df):
    return sorted(map(str, df.collect()))


def test_replies_meet_their_parents_without_texts(spark):
    rows = [("v", f"p{i}", None, False, None) for i in range(5)]
    rows += [("v", f"r{i}", f"p{i % 6}", True, TEXTS[i % len(TEXTS)]) for i in range(40)] * 2
    c = spark.createDataFrame(rows, "video_id string, comment_id string, parent_id string, is_reply boolean, text string").select(
        "*", F.col("comment_id").alias("author_name"), F.lit(1).alias("like_count"))
    got = joins.replies_with_parents(c)
    assert got.columns == ["video_id", "parent_id", "reply_id", "reply_author", "reply_text", "reply_likes", "parent_author", "parent_likes"]
    assert listed(got.select("reply_id", "parent_author", "reply_text")) == sorted(
        str(r) for r in spark.createDataFrame([(i, p, t) for v, i, p, reply, t in rows if reply and p != "p5"],
                                              "reply_id string, parent_author string, reply_text string").collect())
    # The copies of a text are combined before it moves.
    assert "HashAggregate(keys=[text" in plan(got)
