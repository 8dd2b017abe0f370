"""Periodic runs against their definition."""

import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from chorale.llm import common
from chorale.llm import periodic_runs as pr
from chorale.llm.queries import QUERIES


def found(words, min_words=12, min_periods=2):
    n, runs, collapsed = pr.runs_of(pa.array([" ".join(words)], pa.string()), min_words, min_periods)
    return [(r["start"], r["length"], r["period"]) for r in runs[0].as_py()], collapsed[0].as_py()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=90), st.sampled_from([(12, 2), (2, 2), (5, 3), (12, 4)]))
def test_small_alphabets(words, how):
    assert found(words, *how)[0] == brute.runs(words, *how)


@pytest.mark.parametrize("seed", range(12))
def test_nested_loops(seed):
    """Loops of loops, of periods below and far above PLAIN_LAGS, in words of different frequency."""
    r = random.Random(seed)

    def make(depth):
        if not depth:
            return [f"w{r.randrange(40)}" for _ in range(r.randrange(1, 9))]
        piece = sum((make(depth - 1) for _ in range(r.randrange(1, 4))), [])
        return (piece * 5)[:int(len(piece) * r.choice([1, 1, 2, 2.5, 3.7]))]

    words = sum((make(r.randrange(4)) for _ in range(12)), [])[:1500]
    runs = brute.runs(words)
    assert found(words)[0] == runs
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    assert found(words)[1] == " ".join(w for i, w in enumerate(words) if i not in gone)


def test_texts_of_a_chunk_do_not_meet():
    loop = "a b c d e f".split() * 3
    texts = [" ".join(loop), None, "", " ".join(loop), " ".join(loop[:7]), "  ", " ".join(loop[1:])]
    n, runs, collapsed = pr.runs_of(pa.array(texts, pa.string()), 12, 2)
    assert n.to_pylist() == [18, 0, 0, 18, 7, 0, 17]
    assert [len(x) for x in runs.to_pylist()] == [1, 0, 0, 1, 0, 0, 1]
    assert collapsed.to_pylist() == ["a b c d e f", "", "", "a b c d e f", "a b c d e f a", "", "b c d e f a"]


def test_splitting_recurses():
    """b occurs once, which leaves a once on each side, and so on; the loop survives as one segment."""
    words = "d c a b a c d".split() + ["x", "y", "z"] * 5
    codes = np.unique(words, return_inverse=True)[1]
    kept = pr.split_rare(codes, np.zeros(len(words), dtype=np.int64), 2, 12)
    assert (kept[:7] == -1).all() and (kept[7:] >= 0).all() and len(set(kept[7:].tolist())) == 1


def test_long_loop_and_many_rounds():
    n = 60_000
    words = [f"w{i % 20_001}" for i in range(n)]
    assert found(words)[0] == [(0, n, 20_001)][:1 if n >= 40_002 else 0]
    # One word is peeled off each end at a time.
    peel = [f"p{i}" for i in range(1500)]
    assert found(peel + ["mid"] + peel[::-1])[0] == []


def test_query_small_tables_and_hard_cases(spark, sf, small_rows, edge_dir, edge_rows):
    for where, docs in ((sf, small_rows), (edge_dir, [(r[0], r[1]) for r in edge_rows])):
        rows = sorted(tuple(r) for r in QUERIES["op11_periodic_runs"](spark, where).collect())
        assert rows == sorted(brute.op11(docs))


def test_odd_tables(spark, monkeypatch):
    monkeypatch.setattr(common, "CHUNK_BYTES", 50)  # every chunk holds few texts
    loop = "a b c d e f " * 4
    docs = spark.createDataFrame(
        [(1, loop, 5, "x"), (1, loop, 5, "x"), (None, None, 1, "y"), (None, loop, 2, None), (3, "", 0, "")],
        "doc_id bigint, text string, start bigint, runs string")
    rows = sorted((r["doc_id"] or -1, r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in pr.find_runs(docs).collect())
    run, short = [(0, 24, 6)], "a b c d e f"
    assert rows == [(-1, 0, [], ""), (-1, 24, run, short), (1, 24, run, short), (1, 24, run, short), (3, 0, [], "")]
    assert sorted(r[1] for r in pr.digests(pr.find_runs(docs)).collect()) == [0, 0, 1, 1, 1]
    assert pr.find_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        pr.find_runs(docs, min_periods=1)
