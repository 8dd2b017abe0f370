"""Alignment of two tokenizers: which tokens of one stand for which of the other, and how often over a corpus.

A is a byte-level tokenizer of the tokenizers library, B a SentencePiece model.  Both encode the same text with a space in
front.

*Spans*: the character offsets of A and the spans of B's proto are coarse cuts.  Where several tokens share a character
(a character cut into bytes, or one that fell back to bytes) the offsets are those of the whole character; there the ends
follow from the decoded bytes of the tokens, counted from the last cut.  A text whose tokens do not give back its bytes
(a space mark in it) has no tokens at all.

*Groups* are what lies between two places at which tokens of both end.  A *link* is a pair of tokens that overlap: every
end of a token, of A or B, closes exactly one.

*Units*: neither tokenizer joins over a single space between two other characters, so a text is cut there, and every
different unit is encoded once per worker (a bounded table).  The ids of both are written, document by document; links,
groups and counts are made of them, in numpy, a batch of documents at a time.

*Counts*: a pair of ids counts once per document.  Tasks add up what they have seen before it is shuffled; the pairs are a
table over the two vocabularies, written once.  It goes to the workers if it has at most ``lookup_pairs`` rows; beyond
that, the pairs of each document are shuffled and joined with it.

Defined results: a null or empty text has no tokens (zeros and an empty groups string); a null id is kept; repeated rows
give repeated rows, and count as often in the pairs; an empty table gives no rows; very long texts are encoded whole;
columns other than id and text are not read.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorale.llm.common import small_batches, text_chunks, tokenizer_path, worker_state
from chorale.session import materialise

BYTE_VOCABULARY, PIECE_MODEL = "byte_bpe_50k.json", "piece_bpe_32k.model"
SPACE = "▁"
#: Units and tokens (of each side) remembered by a worker; beyond that only units that were seen again stay.
MAX_UNITS, MAX_TOKENS, MAX_UNIT_CHARS = 350_000, 3_000_000, 64
#: Units encoded in one call.
UNITS_A_CALL = 1000
#: Tokens of A whose links are made together; a longer document by itself.
TOKENS_A_CHUNK = 500_000
#: Pairs a task holds before it hands them on.
HELD_PAIRS = 300_000
#: Rows of the table of pairs that may go to the workers: 17 bytes each.
LOOKUP_PAIRS = 4_000_000

_BESIDE = r"[\s▁]"
_ODD_SPACE = re.compile(f" {_BESIDE}|{_BESIDE} |^ | $")
_CUT = re.compile(f"(?<!{_BESIDE})(?<!^) (?!{_BESIDE})(?!$)")


def byte_of_char() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones of Latin-1 for themselves, the
    others in order from U+0100 on."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def units_of(text: str) -> list[str]:
    """The text cut at single spaces between two other characters; each unit had (or gets) a space in front."""
    return _CUT.split(text) if _ODD_SPACE.search(text) else text.split(" ")


def _odd(unit: str) -> bool:
    """Whether a unit may not stand between two others: it is empty, or begins or ends with what may join a space."""
    return not unit or unit[0].isspace() or unit[-1].isspace() or unit[0] == SPACE or unit[-1] == SPACE


def _merged(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values of two rising arrays, and those that both have."""
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    if not len(both):
        return both, both
    last = np.append(both[1:] != both[:-1], True)
    first = np.append(True, both[1:] != both[:-1])
    return both[last], both[last & ~first]


def refined_ends(starts: np.ndarray, ends: np.ndarray, sizes: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """Ends of tokens in bytes.  ``shared`` tokens lie in one character with the next one: they end as many bytes behind
    the last cut as the tokens since then have."""
    if not shared.any():
        return ends
    follows = np.concatenate([[False], shared[:-1]])
    first = np.flatnonzero(~follows)
    chain = np.cumsum(~follows) - 1
    done = np.cumsum(sizes)
    before = (done - sizes)[first][chain]
    return np.where(shared, starts[first][chain] + done - before, ends)


class Aligner:
    def __init__(self, vocabulary: str, model: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(vocabulary)
        self.a.encode_special_tokens = True
        spec = json.loads(vocabulary)
        cut = spec["pre_tokenizer"]
        if spec["normalizer"] or cut["type"] != "ByteLevel" or cut["add_prefix_space"] or not cut["use_regex"]:
            raise ValueError("the first tokenizer has to be a byte-level one without a prefix space")
        byte = byte_of_char()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(n)]
        self.b_is_byte = np.array([self.b.is_byte(i) for i in range(n)])
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("pieces with a space mark behind another character are not handled")
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b_is_byte[i] else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.a_size, self.b_size = (np.array([len(x) for x in v], dtype=np.int64) for v in (self.a_bytes, self.b_bytes))
        self.n_a, self.n_b = len(self.a_bytes), n
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.count = 0
        #: Tokens of all units, where each unit's end (one row ahead), and whether a unit loses bytes.
        self.tokens = [np.zeros(4096, dtype=np.int32), np.zeros(4096, dtype=np.int32)]
        self.ends = [np.zeros(1025, dtype=np.int64), np.zeros(1025, dtype=np.int64)]
        self.lost = np.zeros(1024, dtype=bool)
        self.again = np.zeros(1024, dtype=bool)  # seen more than once since the table was made smaller

    def shrink(self) -> None:
        """Forget the units that were not seen again; all of them, if that would leave the table half full."""
        kept = [(u, n) for u, n in self.index.items() if self.again[n]]
        if 2 * len(kept) > MAX_UNITS:
            kept = []
        numbers = np.array([n for _, n in kept], dtype=np.int64)
        tokens, ends, lost = self.tokens, self.ends, self.lost[numbers]
        self.clear()
        if kept:
            sizes = [e[numbers + 1] - e[numbers] for e in ends]
            places = [np.repeat(e[numbers + 1] - np.cumsum(k), k) + np.arange(k.sum()) for e, k in zip(ends, sizes)]
            self._remember([u for u, _ in kept], [t[p] for t, p in zip(tokens, places)], sizes, lost)

    def _encode(self, units: list[str]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
        """ids of A and B, how many each unit has, and which units lose bytes; the units may stand in one text."""
        text = " " + " ".join(units)
        raw = text.encode()
        n, size = len(units), np.array([1 + len(u.encode()) for u in units], dtype=np.int64)
        unit_end = np.cumsum(size)
        points = np.frombuffer(text.encode("utf-32-le"), "<u4")
        byte_at = np.concatenate([[0], np.cumsum(1 + (points >= 0x80) + (points >= 0x800).astype(int) + (points >= 0x10000))])
        found = self.a.encode(text, add_special_tokens=False)
        a = np.array(found.ids, dtype=np.int64)
        off = np.fromiter(chain.from_iterable(found.offsets), dtype=np.int64, count=2 * len(a)).reshape(-1, 2)
        shared = np.append(off[1:, 0] < off[:-1, 1], False) if len(a) else np.zeros(0, dtype=bool)
        a_end = refined_ends(byte_at[off[:, 0]], byte_at[off[:, 1]], self.a_size[a], shared)

        spans = [(p.id, p.end) for p in self.b.encode(text[1:], return_type="proto").pieces]
        b, b_end = np.fromiter(chain.from_iterable(spans), dtype=np.int64, count=2 * len(spans)).reshape(-1, 2).T
        b_end = b_end + 1  # the space that B puts in front is the first byte
        # Bytes of one character: the last of them carries its span.
        is_byte, width = self.b_is_byte[b], np.diff(b_end, prepend=0)
        shared = np.append(is_byte[:-1] & is_byte[1:] & (width[:-1] == 0), False) if len(b) else np.zeros(0, dtype=bool)
        b_end = refined_ends(np.concatenate([[0], b_end[:-1]]), b_end, self.b_size[b], shared)

        lost, counts = np.zeros(n, dtype=bool), []
        for ids, end, table, sizes in ((a, a_end, self.a_bytes, self.a_size), (b, b_end, self.b_bytes, self.b_size)):
            of = np.minimum(np.searchsorted(unit_end, end, side="left"), n - 1)
            counts.append(np.bincount(of, minlength=n))
            parts = [table[i] for i in ids.tolist()]
            if b"".join(parts) == raw and np.array_equal(np.cumsum(sizes[ids]), end):
                continue
            bounds = np.concatenate([[0], np.cumsum(counts[-1])])
            for k in range(n):
                lost[k] |= b"".join(parts[bounds[k]:bounds[k + 1]]) != raw[unit_end[k] - size[k]:unit_end[k]]
        return [a, b], counts, lost

    def _remember(self, units: list[str], ids: list[np.ndarray], counts: list[np.ndarray], lost: np.ndarray) -> None:
        n, to = self.count, self.count + len(units)
        while len(self.lost) < to:
            self.lost, self.again = (np.concatenate([v, np.zeros_like(v)]) for v in (self.lost, self.again))
            self.ends = [np.concatenate([e, np.zeros_like(e)]) for e in self.ends]
        for side in (0, 1):
            held = int(self.ends[side][n])
            while len(self.tokens[side]) < held + len(ids[side]):
                self.tokens[side] = np.concatenate([self.tokens[side], np.zeros_like(self.tokens[side])])
            self.tokens[side][held:held + len(ids[side])] = ids[side]
            self.ends[side][n + 1:to + 1] = held + np.cumsum(counts[side])
        self.lost[n:to] = lost
        self.index.update(zip(units, range(n, to)))
        self.count = to

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For A and for B: the ids of all texts, text by text, and where each text's begin (with the end of the last)."""
        parts = [units_of(t) if t else [] for t in texts]
        different = set().union(*parts)
        new = different - self.index.keys()
        if self.count + len(new) > MAX_UNITS or max(e[self.count] for e in self.ends) > MAX_TOKENS:
            self.shrink()
            new = different - self.index.keys()
        before = self.count
        plain, odd = [], []
        for u in new:
            (odd if _odd(u) else plain).append(u)
        for at in range(0, len(plain), UNITS_A_CALL):
            some = plain[at:at + UNITS_A_CALL]
            self._remember(some, *self._encode(some))
        for u in odd:
            self._remember([u], *self._encode([u]))
        numbers = np.array(list(map(self.index.__getitem__, chain.from_iterable(parts))), dtype=np.int64)
        for u in new:
            if len(u) > MAX_UNIT_CHARS:
                del self.index[u]  # its place is taken until the table is emptied
        times = np.bincount(numbers, minlength=self.count)
        self.again[:before] |= times[:before] > 0
        self.again[before:self.count] = times[before:] > 1
        text = np.repeat(np.arange(len(texts)), [len(p) for p in parts])
        bad = np.zeros(len(texts), dtype=bool)
        bad[text[self.lost[numbers]]] = True
        keep = ~bad[text]
        text, numbers = text[keep], numbers[keep]
        out = []
        for tokens, ends in zip(self.tokens, self.ends):
            size = ends[numbers + 1] - ends[numbers]
            place = np.repeat(ends[numbers + 1] - np.cumsum(size), size) + np.arange(size.sum())
            offsets = np.concatenate([[0], np.cumsum(np.bincount(text, weights=size, minlength=len(texts)))]).astype(np.int64)
            out.append((tokens[place], offsets))
        return out


class Links:
    """Links and groups of a batch of texts, of the ids of both sides and the bytes that each id has."""

    def __init__(self, a: np.ndarray, a_at: np.ndarray, b: np.ndarray, b_at: np.ndarray, a_size: np.ndarray, b_size: np.ndarray):
        self.a, self.a_at, self.b, self.b_at, self.n = a, a_at, b, b_at, len(a_at) - 1
        # Ends in the bytes of all texts together: both sides of a text have the same bytes.
        self.a_end, self.b_end = np.cumsum(a_size[a]), np.cumsum(b_size[b])
        self.closing, self.common = _merged(self.a_end, self.b_end)
        self.of_a, self.of_b = np.searchsorted(self.a_end, self.closing), np.searchsorted(self.b_end, self.closing)
        text_end = np.concatenate([[0], self.a_end])[a_at]
        # Texts without tokens have no bytes here, so nothing ends in them.
        self.link_at = np.searchsorted(self.closing, text_end, side="right")
        self.group_at = np.searchsorted(self.common, text_end, side="right")

    def figures(self) -> list[np.ndarray]:
        return [np.diff(v) for v in (self.a_at, self.b_at, self.group_at, self.link_at)]

    def codes(self, n_b: int) -> np.ndarray:
        return self.a[self.of_a].astype(np.int64) * n_b + self.b[self.of_b]

    def pairs(self, n_a: int, n_b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """text number, code and number of links of every pair that a text has linked."""
        text = np.repeat(np.arange(self.n), np.diff(self.link_at))
        keys = text * np.int64(n_a * n_b) + self.codes(n_b)
        keys.sort()
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else keys
        text, code = np.divmod(keys[first], n_a * n_b)
        return text, code, np.diff(np.append(first, len(keys)))

    def sums(self, values: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values)])[self.link_at]
        return np.diff(total)

    def groups(self) -> pa.Array:
        """``a1,a2|b1;a3|b2,b3`` for each text, empty without tokens."""
        sides = []
        for ids, end in ((self.a, self.a_end), (self.b, self.b_end)):
            to = np.concatenate([[0], np.searchsorted(end, self.common, side="right")]).astype(np.int32)
            sides.append(pc.binary_join(pa.ListArray.from_arrays(pa.array(to), pc.cast(pa.array(ids), pa.string())), ","))
        each = pc.binary_join_element_wise(*sides, "|")
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(self.group_at.astype(np.int32)), each), ";")


def _add(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    codes, which = np.unique(codes, return_inverse=True)
    return codes, np.bincount(which, weights=counts, minlength=len(codes)).astype(np.int64)


class Alignment:
    """The two vocabularies, and the jobs over documents."""

    def __init__(self, vocabulary_path: str | None = None, model_path: str | None = None, lookup_pairs: int = LOOKUP_PAIRS):
        with open(vocabulary_path or tokenizer_path(BYTE_VOCABULARY), encoding="utf-8") as f:
            vocabulary = f.read()  # two megabytes; they go to the workers with the task
        with open(model_path or tokenizer_path(PIECE_MODEL), "rb") as f:
            model = f.read()
        name = f"alignment_{hash((vocabulary, model))}"
        self.aligner = lambda: worker_state(name, lambda: Aligner(vocabulary, model))
        self.lookup_pairs = lookup_pairs

    def encode(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """doc_id, row (a number of the row), a_ids, b_ids (none where bytes are lost); a written table."""
        make = self.aligner
        small_batches(docs.sparkSession)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            aligner = make()
            for batch in batches:
                at = 0
                for texts in text_chunks(batch.column(2)):
                    sides = [pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
                             for ids, offsets in aligner.encode(texts.to_pylist())]
                    yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(at, len(texts)) for i in (0, 1)), *sides],
                                                     ["doc_id", "row", "a_ids", "b_ids"])
                    at += len(texts)

        rows = docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col(text_col).alias("text"))
        return materialise(rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, row bigint, a_ids array<int>, b_ids array<int>"),
                           "alignment-ids")

    def _batches(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Links]]:
        """Batches cut to about TOKENS_A_CHUNK tokens, with their links."""
        aligner = self.aligner()
        for batch in batches:
            size = np.cumsum(pc.list_value_length(batch.column("a_ids")).to_numpy(zero_copy_only=False).astype(np.int64))
            at = 0
            while at < batch.num_rows:
                to = max(at + 1, int(size.searchsorted((size[at - 1] if at else 0) + TOKENS_A_CHUNK, side="right")))
                some = batch.slice(at, to - at)
                sides = []
                for name in ("a_ids", "b_ids"):
                    column = some.column(name)
                    offsets = column.offsets.to_numpy().astype(np.int64)
                    sides += [column.flatten().to_numpy(), offsets - offsets[0]]
                yield some, Links(*sides, aligner.a_size, aligner.b_size)
                at = to

    def pair_counts(self, encoded: DataFrame) -> DataFrame:
        """a_id, b_id, n_docs (documents that hold the pair linked), best (the highest count of its a_id); a written table."""
        make, cut = self.aligner, self._batches
        small_batches(encoded.sparkSession)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            aligner, codes, counts, fresh = make(), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), []
            aligner.clear()  # the units are not needed any more

            def rows():
                a, b = np.divmod(codes, aligner.n_b)
                return pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(counts)], ["a_id", "b_id", "n_docs"])

            for _, links in cut(batches):
                fresh.append(links.pairs(aligner.n_a, aligner.n_b)[1])
                if sum(map(len, fresh)) > HELD_PAIRS:
                    every = np.concatenate(fresh)
                    codes, counts = _add(np.concatenate([codes, every]), np.concatenate([counts, np.ones(len(every))]))
                    fresh = []
                    if len(codes) > HELD_PAIRS:
                        yield rows()
                        codes, counts = codes[:0], counts[:0]
            every = np.concatenate([*fresh, codes[:0]])
            codes, counts = _add(np.concatenate([codes, every]), np.concatenate([counts, np.ones(len(every))]))
            yield rows()

        seen = encoded.select("a_ids", "b_ids").mapInArrow(run, "a_id int, b_id int, n_docs bigint")
        pairs = materialise(seen.groupBy("a_id", "b_id").agg(F.sum("n_docs").alias("n_docs")), "alignment-pairs")
        best = pairs.groupBy("a_id").agg(F.max("n_docs").alias("most"))
        return materialise(pairs.join(best, "a_id").select("a_id", "b_id", "n_docs", (F.col("n_docs") == F.col("most")).alias("best")),
                           "alignment-best")

    def align(self, encoded: DataFrame, pairs: DataFrame) -> DataFrame:
        """doc_id, n_a, n_b, n_groups, n_links, n_best (links whose count is the best of their A id), count_sum (of the counts
        of all links), groups (``a1,a2|b1;a3|b2,b3``)."""
        make, cut = self.aligner, self._batches
        small_batches(encoded.sparkSession)
        table = None
        if pairs.count() <= self.lookup_pairs:  # bounded: 17 bytes for each of at most lookup_pairs rows
            t = pairs.toArrow()
            a, b, n, best = (t.column(c).to_numpy() for c in ("a_id", "b_id", "n_docs", "best"))
            by = np.lexsort((b, a))
            table = encoded.sparkSession.sparkContext.broadcast((a[by], b[by], n[by], best[by]))
        names = ["doc_id", "row", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            aligner = make()
            if table is not None:
                a, b, n, best = table.value
                known = a.astype(np.int64) * aligner.n_b + b
            for batch, links in cut(batches):
                scores = [np.zeros(links.n, dtype=np.int64)] * 2
                if table is not None:
                    at = np.searchsorted(known, links.codes(aligner.n_b))
                    scores = [links.sums(best[at].astype(np.int64)), links.sums(n[at])]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id"), batch.column("row"), *map(pa.array, (*links.figures(), *scores)), links.groups()], names)

        longs = ", ".join(f"{c} bigint" for c in names[1:-1])
        aligned = encoded.mapInArrow(run, f"doc_id {dict(encoded.dtypes)['doc_id']}, {longs}, groups string")
        if table is not None:
            return aligned.drop("row")
        zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
        return aligned.drop("n_best", "count_sum").join(self._joined_sums(encoded, pairs), "row", "left").select(
            "doc_id", *names[2:6], zero("n_best"), zero("count_sum"), "groups")

    def _joined_sums(self, encoded: DataFrame, pairs: DataFrame) -> DataFrame:
        """row, n_best, count_sum by a join of the pairs of each document."""
        make, cut = self.aligner, self._batches

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            aligner = make()
            for batch, links in cut(batches):
                text, code, times = links.pairs(aligner.n_a, aligner.n_b)
                a, b = np.divmod(code, aligner.n_b)
                yield pa.RecordBatch.from_arrays([
                    batch.column("row").take(pa.array(text)), pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(times)],
                    ["row", "a_id", "b_id", "times"])

        linked = encoded.select("row", "a_ids", "b_ids").mapInArrow(run, "row bigint, a_id int, b_id int, times bigint")
        return linked.join(pairs, ["a_id", "b_id"]).groupBy("row").agg(
            F.sum(F.col("times") * F.col("best").cast("int")).alias("n_best"), F.sum(F.col("times") * F.col("n_docs")).alias("count_sum"))


def align_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The alignment of all documents, with the counts of all of them."""
    own = Alignment(**how)
    encoded = own.encode(docs, id_col, text_col)
    return own.align(encoded, own.pair_counts(encoded))


def digests(aligned: DataFrame) -> DataFrame:
    hashed = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    return aligned.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", hashed.alias("groups_sha256"))
