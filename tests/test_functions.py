import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from chorale.functions import text as tx
from chorale.functions.sentiment import add_sentiment, lexicon_scorer, model_scorer, score_by_lexicon_join
from chorale.functions.time import iso_duration_seconds, iso_timestamp
from frames import plan


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def apply(spark, f, values, kind="string"):
    df = column(spark, values, kind).select("i", f(F.col("v")).alias("o"))
    return [r["o"] for r in df.orderBy("i").collect()]


def plain_file_title(title, n=60):
    kept = re.sub(r"[^\w\s\-]", "", title).strip()
    return re.sub(r"\s+", "_", kept)[:n]


def test_sanitise_title_agrees_with_plain_python(spark):
    titles = [
        "Video #1: intro & tips!", "  spaces\tand\nbreaks  ", "ñandú – çelik", "日本語 タイトル!", "a_b-c (d)", "x" * 80,
        "emoji \U0001f389 party \U0001f389", "x\u00b2 + y\u00b2", "\u00a0nbsp\u2003em\u3000", "\x1cseparators\x1d here\x1f", "!!!", "",
        "word " * 30, "\u00dcn\u00efc\u00f6d\u00e9 \uff26\uff35\uff2c\uff2c width", "line\u2028sep",
    ]
    assert apply(spark, tx.sanitise_title, titles) == [plain_file_title(t) for t in titles]


def test_sanitise_title_drops_combining_marks_like_a_word_class(spark):
    assert apply(spark, tx.sanitise_title, ["e\u0301clair"]) == [plain_file_title("e\u0301clair")]


def test_handles_and_slugs(spark):
    raw = ["abc", "@abc", " \tabc\n", "@@x/y", "a/b/c", ""]
    handles = apply(spark, tx.channel_handle, raw)
    assert handles == ["@abc", "@abc", "@abc", "@@x/y", "@a/b/c", "@"]
    assert apply(spark, tx.channel_slug, handles) == ["abc", "abc", "abc", "x_y", "a_b_c", ""]


def test_preview_counts_characters(spark):
    assert apply(spark, lambda c: tx.preview(c, 3), ["abcdef", "🎉🎉🎉🎉", "a", None]) == ["abc", "🎉🎉🎉", "a", None]


def test_word_count(spark):
    assert apply(spark, tx.word_count, ["one two", "  a\n b c ", "", "   "]) == [2, 3, 0, 0]


def test_comment_line_survives_missing_parts(spark):
    df = spark.createDataFrame([(None, "t", 1), ("a", None, None)], "a string, t string, n long")
    rows = [r[0] for r in df.select(tx.comment_line(F.col("a"), F.col("t"), F.col("n"))).collect()]
    assert rows == ["[]: t (likes: 1)", "[a]:  (likes: )"]


def test_timestamps(spark):
    values = ["2024-01-01T10:00:00Z", "2024-01-01T10:00:00+05:30", None]
    shown = apply(spark, lambda c: iso_timestamp(c).cast("string"), values)
    assert shown == ["2024-01-01 10:00:00", "2024-01-01 04:30:00", None]
    assert apply(spark, lambda c: iso_timestamp(c, "null"), ["junk"]) == [None]
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP|CAST_INVALID_INPUT"):
        apply(spark, iso_timestamp, ["junk"])
    with pytest.raises(ValueError):
        iso_timestamp(F.col("v"), "ignore")


def test_durations(spark):
    values = ["PT1H2M3S", "PT15M", "PT45S", "P1DT1S", "P2D", "PT0S", "PT2H5S", "PT", "P", "1:00", "", None, "PT1M1H"]
    expected = [3723, 900, 45, 86401, 172800, 0, 7205, None, None, None, None, None, None]
    assert apply(spark, iso_duration_seconds, values) == expected


TEXTS = [
    "Great great video", "the WORST, bad", "good but bad", "nothing here", None, "", "goodness badly", "don't love'",
    "love.love,bad", "İstanbul GREAT", "best-ever", "GOOD\nGOOD\nbad",
]
LABELS = [
    "positive", "negative", "neutral", "neutral", None, "neutral", "neutral", "neutral",
    "positive", "positive", "positive", "positive",
]


def test_lexicon_scorer(spark):
    assert apply(spark, lexicon_scorer(), TEXTS) == LABELS


def test_scorer_runs_without_python_workers(spark):
    df = column(spark, TEXTS).select(lexicon_scorer()(F.col("v")))
    assert "Python" not in plan(df) and "ArrowEval" not in plan(df)


@pytest.mark.parametrize("broadcast_below", ["10m", "-1"])
def test_lexicon_join_equals_expression(spark, broadcast_below):
    """Also when the lexicon is too long to be broadcast."""
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast_below)
    comments = column(spark, TEXTS).select(F.col("i").cast("string").alias("comment_id"), F.col("v").alias("text"))
    words = {"great": 1, "good": 1, "love": 1, "best": 1, "worst": -1, "bad": -1}
    lexicon = spark.createDataFrame(list(words.items()), "word string, weight int")
    scorer = lexicon_scorer([w for w in words if words[w] > 0], [w for w in words if words[w] < 0])
    expected = {r["comment_id"]: r["sentiment"] for r in add_sentiment(comments, scorer).collect()}
    joined = score_by_lexicon_join(comments, lexicon)
    got = {r["comment_id"]: r["sentiment"] for r in joined.collect()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
    assert got == expected


def test_model_scorer_sees_no_nulls(spark):
    def predict(texts: pd.Series) -> pd.Series:
        assert texts.notna().all()
        return texts.str.len().gt(3).map({True: "positive", False: "negative"})

    assert apply(spark, model_scorer(predict), ["long text", None, "abc"]) == ["positive", None, "negative"]


def test_lexicon_join_labels_every_row(spark):
    from chorale.functions.sentiment import add_sentiment, score_by_lexicon_join
    rows = [(None, "best best worst"), (None, "bad"), ("1", "good"), ("1", "good"), ("2", None), ("3", "")]
    df = spark.createDataFrame(rows, "comment_id string, text string")
    lexicon = spark.createDataFrame([("best", 1), ("good", 1), ("worst", -1), ("bad", -1)], "word string, weight int")
    joined = score_by_lexicon_join(df, lexicon)
    plain = add_sentiment(df).select("comment_id", "sentiment")
    assert sorted(map(str, joined.collect())) == sorted(map(str, plain.collect()))


def test_schemas_leave_other_tables_alone(spark, sf, tmp_path):
    import __spark_entry__ as entry
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS yt_silver LOCATION '{tmp_path}/s'")
    spark.range(3).write.mode("overwrite").saveAsTable("yt_silver.comments")
    entry.queries()["catalog_schemas"](spark, sf).collect()
    assert spark.table("yt_silver.comments").count() == 3
    spark.sql("DROP SCHEMA yt_silver CASCADE")
