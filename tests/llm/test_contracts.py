"""Every query against a plain version of its contract: hard cases, and the smallest tables."""

import brute
import pytest

from chorale.llm.queries import QUERIES

CASES = {
    "op1_token_files": (brute.op1, ["doc_id", "start", "n_tokens", "ids_crc32"]),
    "op2_secrets": (brute.op2, ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256"]),
    "op5_quality": (brute.op5, ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]),
    "op6_exact_dedup": (brute.op6, ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]),
    "op8_sentencepiece": (brute.op8, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]),
    "op9_personal_data": (brute.op9, ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256"]),
}


def rows(df, columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


@pytest.mark.parametrize("name", sorted(CASES))
def test_hard_cases(spark, edge_dir, edge_rows, name):
    plain, columns = CASES[name]
    expected = {r[0]: r for r in plain([(r[0], r[1]) for r in edge_rows])}
    found = {r[0]: r for r in rows(QUERIES[name](spark, edge_dir), columns)}
    assert found.keys() == expected.keys()
    texts = {r[0]: r[1] for r in edge_rows}
    wrong = [(texts[k] and texts[k][:60], found[k], expected[k]) for k in found if found[k] != expected[k]]
    assert not wrong, wrong[:3]


@pytest.mark.parametrize("name", sorted(CASES))
def test_small_tables(spark, sf, small_rows, name):
    plain, columns = CASES[name]
    assert rows(QUERIES[name](spark, sf), columns) == sorted(plain(small_rows))
