"""SentencePiece encoding (merge type, byte fallback) by backtracking, and decoding.

A sequence of pieces is what merging by score gives if and only if every two neighbours, put together and merged
again, come out as the same two pieces.  So an encoding is found without a merge queue:

* one Aho-Corasick pass over the new words of a batch gives the longest piece that starts at each character;
* walking left to right, the longest piece is tried first, then the pieces that are its prefixes, longest first;
* a piece is taken if it is compatible with the one before it (by merging the two again, remembered per pair) and
  the position behind it is not marked in a bitfield of positions from which no encoding goes on;
* if none fits, the position is marked, the last piece is given back and a shorter one is tried in its place.

No piece of the model holds a space mark behind another character, and a character of no piece is never merged, so
texts are cut there into words, and each different word is encoded once per worker (a bounded table).

Defined results: a null or empty text has no ids and decodes to the empty text; a null id is kept; repeated rows give
repeated rows; an empty table gives no rows; very long texts and words are encoded whole; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorale.llm.common import small_batches, tokenizer_path, worker_state

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
#: Words and pairs remembered by a worker; the tables are emptied beyond that.
MAX_WORDS, MAX_WORD_CHARS, MAX_PAIRS = 600_000, 64, 1_000_000


class Encoder:
    def __init__(self, model: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        self.piece = [sp.id_to_piece(i) for i in range(n)]
        self.byte_of = {i: int(self.piece[i][3:5], 16) for i in range(n) if sp.is_byte(i)}
        self.byte_id = {b: i for i, b in self.byte_of.items()}
        plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        if any(SPACE in self.piece[i].lstrip(SPACE) for i in plain):
            raise ValueError("pieces with a space mark behind another character are not handled")
        self.score = {self.piece[i]: sp.get_score(i) for i in plain}
        chars = {c for i in plain for c in self.piece[i]}
        if "\n" in chars:
            raise ValueError("pieces with line breaks are not handled")
        # Characters that occur in pieces but are none themselves take part in merges; alone they fall back to bytes.
        extra = sorted(chars - self.score.keys())
        self.first_extra = n
        self.piece += extra
        tokens = [i for i in plain if self.merge(self.piece[i]) == [self.piece[i]]] + list(range(n, n + len(extra)))
        self.size = [len(p) for p in self.piece]
        self.automaton = ahocorasick.Automaton()
        ids = {}
        for i in tokens:
            self.automaton.add_word(self.piece[i], i)
            ids[self.piece[i]] = i
        self.automaton.make_automaton()
        self.shorter = {}
        for p, i in ids.items():
            self.shorter[i] = next((ids[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in ids), -1)
        self.chars = chars
        self.gap = next(c for c in map(chr, range(0x10FFFF)) if c not in chars)
        self.words: dict[str, tuple[str, str]] = {}  # ids, and what they decode to
        self.pairs: dict[int, bool] = {}

    def merge(self, text: str) -> list[str]:
        """Merge by score, leftmost first among equals: the definition, for short strings."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = score.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, a: int, b: int) -> bool:
        key = a << 32 | b
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= MAX_PAIRS:
                self.pairs.clear()
            p, q = self.piece[a], self.piece[b]
            known = self.pairs[key] = self.merge(p + q) == [p, q]
        return known

    def _run(self, longest: list[int], start: int, end: int) -> list[int]:
        """Pieces of the characters start..end, all of which occur in pieces."""
        size, shorter, pairs = self.size, self.shorter, self.pairs
        tokens: list[int] = []
        failed, at, token = bytearray(end - start + 1), start, longest[start]
        while at < end:
            last = tokens[-1] if tokens else -1
            while True:
                to = at + size[token]
                if not failed[to - start]:
                    ok = last < 0 or pairs.get(last << 32 | token)
                    if ok is None:
                        ok = self.compatible(last, token)
                    if ok:
                        tokens.append(token)
                        at = to
                        if at < end:
                            token = longest[at]
                        break
                token = shorter[token]
                if token < 0:
                    failed[at - start] = 1
                    token = tokens.pop()
                    at -= size[token]
                    break
        return tokens

    def encode_words(self, words: list[str]) -> list[list[int]]:
        joined = self.gap.join(words)
        longest, size = [-1] * len(joined), self.size
        for end, token in self.automaton.iter(joined):
            longest[end + 1 - size[token]] = token  # longer matches of a start come later
        out, at = [], 0
        for w in words:
            ids: list[int] = []
            end = at + len(w)
            while at < end:
                if longest[at] < 0:
                    ids += [self.byte_id[b] for b in joined[at].encode("utf-8")]
                    at += 1
                    continue
                stop = at
                while stop < end and longest[stop] >= 0:
                    stop += 1
                for t in self._run(longest, at, stop):
                    ids += [t] if t < self.first_extra else [self.byte_id[b] for b in self.piece[t].encode("utf-8")]
                at = stop
            out.append(ids)
            at = end + 1
        return out

    def decode(self, ids: list[int]) -> str:
        """Text of the ids, the space mark of the start included (as a space)."""
        out, raw = [], bytearray()
        for i in ids:
            b = self.byte_of.get(i)
            if b is not None:
                raw.append(b)
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
            out.append(self.piece[i])
        if raw:
            out.append(raw.decode("utf-8", "replace"))
        return "".join(out).replace(SPACE, " ")

    def _parts(self, text: str) -> list[str]:
        """A text cut into words.  A word that starts with a line break or a space mark is meant as it stands; any
        other has one space mark in front."""
        s = SPACE + text.replace(" ", SPACE).replace("\n", SPACE + "\n")
        if SPACE + SPACE not in s and s[-1] != SPACE:
            return s.split(SPACE)[1:]
        s = SPACE + text.replace(" ", SPACE)
        # Several space marks in a row stay together with the word behind them.
        found = re.findall(f"\n[^{SPACE}\n]*|{SPACE}+[^{SPACE}\n]*", s)
        return [p[1:] if p[0] == SPACE and len(p) > 1 and p[1] != SPACE else p for p in found]

    def batch(self, texts: list[str | None]) -> Iterator[tuple[int, str, str]]:
        """(number of ids, ids as decimals joined by commas, decoded text) of each text."""
        parts = [self._parts(t) if t else [] for t in texts]
        new = list(set().union(*parts) - self.words.keys())
        if len(self.words) + len(new) > MAX_WORDS:
            self.words.clear()
            new = list(set().union(*parts))
        words = self.words
        chunks = [p if p[0] in "\n" + SPACE else SPACE + p for p in new]
        for p, ids in zip(new, self.encode_words(chunks)):
            words[p] = ",".join(map(str, ids)), self.decode(ids)
        for own in parts:
            if not own:
                yield 0, "", ""
                continue
            found = [words[p] for p in own]
            ids = ",".join([i for i, _ in found])
            # The space mark that encoding puts in front is not part of the text.
            yield ids.count(",") + 1, ids, "".join([d for _, d in found])[1:]
        for p in new:
            if len(p) > MAX_WORD_CHARS:
                del words[p]


def encode(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_path: str | None = None
) -> DataFrame:
    """doc_id, n_tokens, ids (decimals joined by commas), decoded (the text that the ids decode to)."""
    with open(model_path or tokenizer_path(MODEL), "rb") as f:
        model = f.read()  # half a megabyte; it goes to the workers with the task
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_state(f"sentencepiece_{hash(model)}", lambda: Encoder(model))
        for b in batches:
            rows = list(encoder.batch(b.column(1).to_pylist()))
            n, ids, decoded = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                ["doc_id", "n_tokens", "ids", "decoded"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, n_tokens bigint, ids string, decoded string")


def decode(
    encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", model_path: str | None = None
) -> DataFrame:
    """doc_id, text: what ids (decimals joined by commas, as ``encode`` gives them) stand for; a null or empty value is the empty text."""
    with open(model_path or tokenizer_path(MODEL), "rb") as f:
        model = f.read()
    small_batches(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_state(f"sentencepiece_{hash(model)}", lambda: Encoder(model))
        for b in batches:
            texts = [encoder.decode(list(map(int, ids.split(","))))[1:] if ids else "" for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    rows = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, text string")


def digests(encoded: DataFrame) -> DataFrame:
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))
