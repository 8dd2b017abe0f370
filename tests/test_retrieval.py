import math
import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chorale.functions.text import term_frequencies
from chorale.operators import retrieval, text_index
from frames import plan


@pytest.fixture(scope="module")
def corpus(spark):
    """Half of the rows share one word; some texts repeat it, some lack all query words."""
    rnd = random.Random(11)
    rows = []
    for i in range(300):
        toks = [rnd.choice(["alpha", "beta", "gamma", "über", "it's"]) for _ in range(rnd.randrange(1, 30))]
        rows.append((f"c{i:03d}", "@c", "T", "u", ("Hot, " if i % 2 else "") + " ".join(toks)))
    return spark.createDataFrame(rows, "comment_id string, channel_handle string, title string, video_url string, text string")


def brute_force(rows, query, k, k1=1.2, b=0.75):
    docs = {r["comment_id"]: re.findall(r"[\w']+", r["text"].lower()) for r in rows}
    n, avg = len(docs), sum(map(len, docs.values())) / len(docs)
    scores = {}
    for cid, toks in docs.items():
        score = 0.0
        for w in query:
            tf, df = toks.count(w), sum(w in d for d in docs.values())
            if tf:
                score += math.log(1 + (n - df + 0.5) / (df + 0.5)) * tf * (k1 + 1) / (tf + k1 * (1 - b + b * len(toks) / avg))
        if score:
            scores[cid] = round(score, 6)
    return sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:k]


@pytest.mark.parametrize("query", [["alpha"], ["hot", "it's"], ["über", "absent"], ["absent"]])
def test_bm25_equals_brute_force_with_and_without_index(spark, corpus, tmp_path, query):
    expected = brute_force(corpus.collect(), query, 7)
    direct = retrieval.bm25_top_k(corpus, [q.upper() for q in query], 7)
    assert [(r["comment_id"], r["score"]) for r in direct.collect()] == expected
    text_index.write_index(corpus, str(tmp_path / "ix"))
    indexed = text_index.search_index(spark, str(tmp_path / "ix"), query, 7)
    assert [(r["comment_id"], r["score"]) for r in indexed.collect()] == expected
    assert indexed.columns == direct.columns


def test_bm25_shuffles_no_texts(corpus):
    p = plan(retrieval.bm25_top_k(corpus, ["alpha"], 3))
    assert "TakeOrderedAndProject" in p and "hashpartitioning" not in p and "Join" not in p


def test_mentions_are_whole_words(spark):
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(["A Best!", "bestow", "the worst-best", None, ""])], "comment_id string, text string")
    df = df.withColumns({c: F.lit("x") for c in ("channel_handle", "title", "video_url")})
    assert sorted(r["comment_id"] for r in retrieval.comments_mentioning(df, ["Best"]).collect()) == ["0", "2"]


def test_follow_up_requests(spark):
    df = spark.createDataFrame([("1", "PART TWO please"), ("2", "nothing"), ("3", None)], "comment_id string, text string")
    df = df.withColumns({c: F.lit("x") for c in ("channel_handle", "title", "video_url")})
    assert [r["comment_id"] for r in retrieval.follow_up_requests(df).collect()] == ["1"]


def test_top_terms(spark):
    df = spark.createDataFrame([("1", "The audio audio is bad"), ("2", "bad and late"), ("3", None)], "comment_id string, text string")
    got = [(r["term"], r["occurrences"]) for r in retrieval.top_terms(df, 2).collect()]
    assert got == [("audio", 2), ("bad", 2)]


def test_term_frequencies(spark):
    texts = ["b a b A, b's", "one", "", None, "x " * 500]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] and [tuple(e) for e in r[0]] for r in df.orderBy("i").select(term_frequencies(F.col("t"))).collect()]
    assert got == [[("a", 2), ("b", 2), ("b's", 1)], [("one", 1)], [], None, [("x", 500)]]


def test_index_search_prunes_buckets(spark, corpus, tmp_path):
    text_index.write_index(corpus, str(tmp_path / "ix"), buckets=16)
    postings = spark.read.parquet(str(tmp_path / "ix/postings"))
    pruned = postings.filter(F.col("bucket").isin(text_index._bucket(F.lit("alpha"), 16)))
    assert "PartitionFilters: [isnotnull(bucket" in plan(pruned) or "PartitionFilters: [(bucket" in plan(pruned)
    assert {r["term"] for r in pruned.filter("term = 'alpha'").collect()} == {"alpha"}


def test_search_words_are_single_words(corpus):
    for bad in ("two words", "", "semi;colon"):
        with pytest.raises(ValueError, match="not a single word"):
            retrieval.bm25_top_k(corpus, [bad], 3)


def test_index_of_several_runs_with_repeated_and_missing_ids(spark, corpus, tmp_path):
    rows = corpus.withColumn("comment_id", F.when(F.col("comment_id") > "c100", F.col("comment_id")))
    for run in (1, 2):
        text_index.write_index(rows, str(tmp_path / "ix"), run_id=run)
        text_index.write_index(rows, str(tmp_path / "ix"), run_id=run)  # a run that is repeated overwrites its own
    found = text_index.search_index(spark, str(tmp_path / "ix"), ["alpha"], 9).select("score", "comment_id").collect()
    expected = retrieval.bm25_top_k(rows.unionByName(rows), ["alpha"], 9).select("score", "comment_id").collect()
    assert found == expected


@pytest.mark.parametrize("query", [["alpha"], ["alpha", "beta", "nothere"], ["gamma", "alpha"]])
@pytest.mark.parametrize("k", [1, 7, 500])
def test_blocks_are_skipped_without_a_change_of_the_ranking(spark, corpus, tmp_path, monkeypatch, query, k):
    monkeypatch.setattr(text_index, "FIRST_BLOCKS", 1)
    text_index.write_index(corpus, str(tmp_path / "ix"), block_docs=9)
    assert spark.read.parquet(str(tmp_path / "ix/postings")).select("block").distinct().count() > 5
    found = text_index.search_index(spark, str(tmp_path / "ix"), query, k)
    assert [(r["comment_id"], r["score"]) for r in found.collect()] == brute_force(corpus.collect(), query, k)


def test_packed_rows_hold_every_count():
    rnd = random.Random(2)
    docs = [(i * 3 + (10 ** 11 if i > 60 else 0), i % 3, [rnd.choice("abcdefg") for _ in range(rnd.randrange(1, 30))]) for i in range(90)]
    columns = lambda rows: pa.RecordBatch.from_arrays([
        pa.array([d for d, _, _ in rows], pa.int64()), pa.array([len(w) for *_, w in rows], pa.int32()),
        pa.array([c for _, c, _ in rows], pa.int64()), pa.array([w for *_, w in rows], pa.list_(pa.string()))], ["doc", "len", "channel", "words"])
    got, blocks = {}, set()
    for b in text_index.pack(iter([columns(docs[:50]), columns(docs[50:])]), block_docs=20):
        for r in b.to_pylist():
            blocks.add(r["block"])
            assert (r["n"], r["max_tf"], r["min_len"]) == (len(r["docs"]), max(r["tfs"]), min(r["lens"]))
            for d, tf, length in zip(r["docs"], r["tfs"], r["lens"]):
                got[r["term"], r["block"] + d] = (tf, length, r["channel"])
    assert got == {(w, d): (ws.count(w), len(ws), c) for d, c, ws in docs for w in set(ws)}
    assert len(blocks) == 6  # 20, 20, 20, one before the gap in the numbers, 20 and 9 behind it
