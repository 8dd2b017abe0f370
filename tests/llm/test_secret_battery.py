"""The battery of the secret scans against a plain version, and what its model is fitted to."""

import random

import pytest
from plain_battery import random_spans
from pyspark.sql import functions as F

from chorale.llm import secrets


def _texts():
    r = random.Random(21)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    make = lambda alphabet, n: "".join(r.choice(alphabet) for _ in range(n))
    words = ["the", "running", "of", "water", "through", "station", "and", "People", "another", "reading", "under", "mountain"]
    out = [f"see {make(alphabet, n)} there" for alphabet in (letters, letters[:26], letters[26:52], letters[26:36] + "/+-_", "0123456789abcdef")
           for n in (16, 21, 40) for _ in range(4)]
    out += [" ".join(r.choice(words) for _ in range(40)) + " " + "".join(r.choice(words) for _ in range(5)) for _ in range(60)]
    out += ["", "a" * 400, "ab" * 300, "1234567890123456", "password=" + make(letters, 30), "x" * 16 + " " + "x" * 16, make(letters, 5000)]
    return out


def test_battery_is_the_plain_one(spark):
    texts = _texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    span = lambda s: F.struct(s["start"], s["end"])
    got = {r["doc_id"]: r for r in secrets.find_secrets(docs).select(
        "doc_id", F.transform("base", span).alias("base"), F.transform("added", span).alias("added"), F.transform(
            "tested", lambda t: F.struct(t["span"]["start"].alias("s"), t["span"]["end"].alias("e"), t["test"]["p"].alias("p"))).alias("tested")).collect()}
    want, ps = random_spans(texts, [[tuple(s) for s in got[i]["base"]] for i in range(len(texts))])
    assert {(i, t["s"], t["e"]) for i, r in got.items() for t in r["tested"]} == set(ps)
    for i, r in got.items():
        for t in r["tested"]:
            assert t["p"] == pytest.approx(ps[i, t["s"], t["e"]], rel=1e-3, abs=1e-6)
    assert [[tuple(s) for s in got[i]["added"]] for i in range(len(texts))] == want
    assert 40 <= sum(map(len, want)) < len(ps)


def test_model_is_fitted_to_every_row(spark):
    """A word that only the last of many documents holds changes the model; copies of a document do not."""
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.lit("some plain words").alias("text"))
    more = docs.union(spark.createDataFrame([(30_000, "zqzqzqzq")], docs.schema))
    one = docs.limit(1)
    assert secrets.word_model(docs) == secrets.word_model(one)
    assert secrets.word_model(more) != secrets.word_model(docs)
