"""Alignment of two tokenizers against a plain version."""

import random

import brute
import numpy as np
import pytest

from chorale.llm import common, token_alignment
from chorale.llm.queries import QUERIES

PIECES = ["word", "Wörld", "naïve", "中文", "😀", "é", "don't", "I'LL", "42", "3.14", "\n", "\t", "  ", " ", "▁", "▁▁", "\xa0", "　",
          "\x1c", "<|endoftext|>", "<s>", "</s>", "<0x41>", "\x00", "‍", "ﬁ", "𝒳", "…", "--", "\r\n", ".\nThe", " \n ", "a"]


def odd_texts(seed, n):
    r = random.Random(seed)
    return [(i, "".join(r.choice(PIECES) + r.choice(["", " ", " ", ""]) for _ in range(r.randrange(12)))) for i in range(n)]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("lookup", [10 ** 6, 0])
def test_odd_texts(spark, monkeypatch, lookup):
    monkeypatch.setattr(common, "CHUNK_BYTES", 300)
    monkeypatch.setattr(token_alignment, "TOKENS_A_CHUNK", 50)
    docs = odd_texts(5, 500) + [(7, "same row here"), (7, "same row here"), (None, "null id"), (None, None)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    found = token_alignment.align_documents(df, lookup_pairs=lookup)
    assert rows(token_alignment.digests(found)) == sorted(brute.op12(docs), key=repr)


def test_table_of_units_is_bounded(monkeypatch):
    monkeypatch.setattr(token_alignment, "MAX_UNITS", 20)
    monkeypatch.setattr(token_alignment, "UNITS_A_CALL", 3)
    own = token_alignment.Alignment()
    aligner = own.aligner()
    texts = [t for _, t in odd_texts(6, 60)] + ["x" * 500]
    together = aligner.encode(texts)
    for i, t in enumerate(texts):
        for (ids, at), (own, own_at) in zip(together, aligner.encode([t])):
            assert own_at.tolist() == [0, len(own)] and own.tolist() == ids[at[i]:at[i + 1]].tolist()
        assert aligner.count <= 20 + len(set(token_alignment.units_of(t)))
    # What was seen again stays.
    aligner.clear()
    for i in range(12):
        aligner.encode([f"often x{i} y{i} z{i}"])
    assert "often" in aligner.index and "x1" not in aligner.index
    assert "x" * 500 not in aligner.index


def test_ends_inside_a_character():
    """Two tokens inside one character of four bytes, then a plain one."""
    ends = token_alignment.refined_ends(np.array([0, 1, 1, 5]), np.array([1, 5, 5, 7]), np.array([1, 3, 1, 2]),
                                        np.array([False, True, False, False]))
    assert ends.tolist() == [1, 4, 5, 7]


def test_query_hard_cases_and_small_tables(spark, sf, small_rows, edge_dir, edge_rows):
    for where, docs in ((edge_dir, [(r[0], r[1]) for r in edge_rows]), (sf, small_rows)):
        assert rows(QUERIES["op12_token_alignment"](spark, where)) == sorted(brute.op12(docs), key=repr)


@pytest.mark.parametrize("lookup", [10 ** 6, 0])
def test_empty_and_clashing(spark, edge_docs, lookup):
    clash = edge_docs.withColumnsRenamed({"lang": "a_id", "source": "groups", "n_chars": "times"})
    own = token_alignment.Alignment(lookup_pairs=lookup)
    none = clash.limit(0)
    encoded, full = own.encode(none), own.encode(clash)
    assert own.align(encoded, own.pair_counts(encoded)).count() == 0
    assert own.align(full, own.pair_counts(full)).columns == [
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
