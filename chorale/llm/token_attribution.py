"""Token counts per field and section, from one encoding of the whole document.

A document is written out as its fields, each followed by a line break, and then its text, whose lines are sections
(a line has its line break).  It is encoded once, as a model would see it.  Bytes of a byte-level token are known from the
vocabulary, so the running sum of token lengths is every token's span, and a sorted search joins the spans with those of
the sections (an interval join inside the document; nothing is shuffled).

A token that crosses a boundary is given by one rule, ``crossing``:
  - ``largest``: whole, to the section that holds most of its bytes (the earlier one if equal);
  - ``first``: whole, to the section in which it starts;
  - ``share``: to each section the part of its bytes that lies in it.
Under every rule the sections of a document add up to its tokens.

Defined results: a null field is an empty field; a null text has no lines, an empty text one empty line; a null id is
kept; repeated rows give repeated rows; an empty table gives no rows; long texts are encoded whole.  Columns other than
id, text and the named fields are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorale.llm.common import small_batches, tokenizer_path, worker_state

VOCABULARY = "byte_bpe_50k.tiktoken"
FIELDS = ("lang", "source")
RULES = ("largest", "first", "share")


class ByteTokens:
    def __init__(self, vocabulary: bytes, pattern: str):
        import tiktoken

        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, vocabulary.splitlines())}
        self.encoding = tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.size = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, rank in ranks.items():
            self.size[rank] = len(token)

    def ends(self, text: str) -> np.ndarray:
        """End of each token, in bytes."""
        return np.cumsum(self.size[np.array(self.encoding.encode_ordinary(text), dtype=np.int64)])


def sections(fields: Sequence[str | None], text: str | None) -> list[str]:
    parts = [(f or "") + "\n" for f in fields]
    if text is not None:
        lines = text.split("\n")
        parts += [x + "\n" for x in lines[:-1]] + [lines[-1]]
    return parts


def attribute(token_ends: np.ndarray, section_sizes: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, crossing tokens that touch it) of each section."""
    n = len(section_sizes)
    stops = np.cumsum(section_sizes)
    starts = np.concatenate([[0], token_ends]).astype(np.int64)[:-1]
    first = np.searchsorted(stops, starts, side="right")
    last = np.searchsorted(stops, token_ends - 1, side="right")
    inside = first == last
    tokens = np.bincount(first[inside], minlength=n).astype(float)
    crossing = np.zeros(n, dtype=np.int64)
    for t in np.flatnonzero(~inside):
        a, b = first[t], last[t] + 1
        edges = np.minimum(np.maximum(np.concatenate([[starts[t]], stops[a:b]]), starts[t]), token_ends[t])
        share = np.diff(edges)
        crossing[a:b] += share > 0
        if rule == "share":
            tokens[a:b] += share / share.sum()
        else:
            tokens[a + (int(np.argmax(share)) if rule == "largest" else 0)] += 1
    return tokens, crossing


def token_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fields: Sequence[str] = FIELDS, crossing: str = "largest",
    vocabulary_path: str | None = None, pattern: str | None = None,
) -> DataFrame:
    """doc_id, section (from 0, in order), name (of the field, or ``line``), n_bytes, n_tokens, n_crossing."""
    if crossing not in RULES:
        raise ValueError(f"crossing must be one of {RULES}")
    if pattern is None:
        import public_tokenizers

        pattern = public_tokenizers.PATTERN
    with open(vocabulary_path or tokenizer_path(VOCABULARY), "rb") as f:
        vocabulary = f.read()  # one megabyte; it goes to the workers with the task
    small_batches(docs.sparkSession)
    names = list(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = worker_state(f"byte_tokens_{hash((vocabulary, pattern))}", lambda: ByteTokens(vocabulary, pattern))
        for b in batches:
            values = [b.column(i).to_pylist() for i in range(2, b.num_columns)]
            rows, numbers, sizes, tokens, crosses, kinds = [], [], [], [], [], []
            for k, text in enumerate(b.column(1).to_pylist()):
                parts = sections([v[k] for v in values], text)
                size = np.array([len(p.encode()) for p in parts], dtype=np.int64)
                n, c = attribute(coder.ends("".join(parts)), size, crossing)
                rows += [k] * len(parts)
                numbers += range(len(parts))
                kinds += names + ["line"] * (len(parts) - len(names))
                sizes.append(size)
                tokens.append(n)
                crosses.append(c)
            join = lambda x, t: pa.array(np.concatenate(x) if x else [], t)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(rows, pa.int64())), pa.array(numbers, pa.int32()), pa.array(kinds, pa.string()),
                 join(sizes, pa.int64()), join(tokens, pa.float64()), join(crosses, pa.int64())],
                ["doc_id", "section", "name", "n_bytes", "n_tokens", "n_crossing"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       *[F.col(f).cast("string").alias(f"field_{i}") for i, f in enumerate(names)])
    counts = rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, section int, name string, n_bytes bigint, "
                                  "n_tokens double, n_crossing bigint")
    return counts if crossing == "share" else counts.withColumn("n_tokens", F.col("n_tokens").cast("bigint"))
