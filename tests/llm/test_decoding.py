"""Decoding of SentencePiece ids."""

import sentencepiece
from public_tokenizers import path

from chorale.llm import sentencepiece_bpe


def test_ids_decode_to_what_the_library_gives(spark, edge_docs, edge_rows):
    sp = sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))
    encoded = sentencepiece_bpe.encode(edge_docs)
    want = sorted(((r[0], sp.decode(sp.encode(r[1] or ""))) for r in edge_rows))
    assert sorted((r["doc_id"], r["decoded"]) for r in encoded.collect()) == want
    assert sorted(map(tuple, sentencepiece_bpe.decode(encoded).collect())) == want
    none = spark.createDataFrame([(1, None), (2, "")], "doc_id bigint, ids string")
    assert sorted(map(tuple, sentencepiece_bpe.decode(none).collect())) == [(1, ""), (2, "")]


def test_long_word_with_many_failed_positions_and_bounded_table(monkeypatch):
    monkeypatch.setattr(sentencepiece_bpe, "MAX_WORDS", 3)
    with open(path("piece_bpe_32k.model"), "rb") as f:
        encoder = sentencepiece_bpe.Encoder(f.read())
    sp = sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))
    for text in ("ab" * 9000 + "q", "😀" * 3000, "one two three four five", "é\x00\x01 ▁▁ x"):
        (n, ids, decoded), = encoder.batch([text])
        assert ids == ",".join(map(str, sp.encode(text))) and decoded == sp.decode(sp.encode(text)) and n == len(sp.encode(text))
        assert len(encoder.words) <= 6
