"""Removal of repeated byte strings against a plain version, and its parts against their definitions."""

import random
from collections import Counter

import brute
import numpy as np
import pytest

from chorale.llm import repeats
from chorale.llm.queries import QUERIES

COLUMNS = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def rows(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def test_hard_cases(spark, edge_dir, edge_rows):
    assert rows(QUERIES["op4_repeats"](spark, edge_dir)) == sorted(brute.op4([(r[0], r[1]) for r in edge_rows]))


def test_small_tables(spark, sf, small_rows):
    assert rows(QUERIES["op4_repeats"](spark, sf)) == sorted(brute.op4(small_rows))


@pytest.mark.parametrize("piece, shard", [(900, 1500), (1 << 20, 600)])
def test_slices_and_pieces(edge_docs, edge_rows, monkeypatch, piece, shard):
    """Texts worked on in short pieces, and anchors cut into slices that meet again by binary search."""
    monkeypatch.setattr(repeats, "PIECE", piece)
    found = repeats.remove_repeats(edge_docs, shard_bytes=shard)
    assert rows(found) == sorted(brute.op4([(r[0], r[1]) for r in edge_rows]))


def test_hot_passage_over_slices(spark):
    """One passage in many contexts: its edge segments all differ."""
    r = random.Random(1)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    passage = " ".join(word() for _ in range(45))
    docs = [(i, " ".join(word() for _ in range(60)) + " " + passage + " " + " ".join(word() for _ in range(60))) for i in range(60)]
    docs += [(100 + i, docs[i][1][-500:]) for i in range(3)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert rows(repeats.remove_repeats(df, shard_bytes=4000)) == sorted(brute.op4(docs))


def test_repeated_rows_null_ids_and_other_columns(spark):
    text = "".join(random.Random(2).choice("abcdefghij ") for _ in range(400))
    df = spark.createDataFrame([(None, text, 1, 2), (7, text, 1, 2), (7, text, 1, 2), (None, None, 1, 2), (8, text[:199], 1, 2)],
                               "doc_id bigint, text string, anchor int, row_key int")
    found = repeats.remove_repeats(df).select("doc_id", "n_removed").collect()
    assert Counter(map(tuple, found)) == Counter([(None, 400), (7, 400), (7, 400), (None, 0), (8, 199 - 199)])
    assert repeats.remove_repeats(df.limit(0)).count() == 0


def test_suffix_array_and_prefixes():
    r = random.Random(3)
    for n in (1, 2, 9, 50, 300):
        for letters in (b"a", b"ab", b"abcdef\x00"):
            raw = bytes(r.choice(letters) for _ in range(n)) + b"\xff"
            text = np.frombuffer(raw, np.uint8)
            words = repeats._words(text)
            sa = repeats.suffix_array(text, words).tolist()
            assert sa == sorted(range(len(raw)), key=lambda i: raw[i:])
            before, size = repeats.common_prefixes(text, words, np.array(sa))
            for a, b in zip(sa, sa[1:]):
                k = 0
                while max(a, b) + k < len(raw) and raw[a + k] == raw[b + k]:
                    k += 1
                assert (before[b], size[b]) == (a, k)


def test_suffix_array_sorts_by_one_number(monkeypatch):
    """Groups and followers of many suffixes fit one sorted number."""
    monkeypatch.setattr(np, "lexsort", None)
    r = random.Random(4)
    unit = bytes(r.choice(b"abcd") for _ in range(40_000))
    raw = unit + b"x" + unit + b"\xff"
    text = np.frombuffer(raw, np.uint8)
    sa = repeats.suffix_array(text, repeats._words(text)).tolist()
    assert sorted(sa) == list(range(len(raw)))
    assert all(raw[a:] < raw[b:] for a, b in zip(sa, sa[1:]))
