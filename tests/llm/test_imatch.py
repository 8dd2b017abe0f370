"""I-Match fingerprints against a plain version, and what they are for."""

import hashlib
import random
from collections import Counter

import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from chorale.llm import imatch
from chorale.llm.queries import QUERIES


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def hash64(*values, seed=42):
    for v in values:
        raw = v.encode() if isinstance(v, str) else v.to_bytes(4 if v == imatch.SEED else 8, "little", signed=True)
        seed = xxhash.xxh64_intdigest(raw, seed)
    return signed(seed)


def terms(text):
    return sorted({hash64(imatch.SEED, w) for w in regex.findall(r"[\p{L}\p{N}]+", text.lower())})


def level_of(h):
    return next(k for k in range(20) if len(h) <= imatch.MOST_TERMS * 4 ** k)


def on(h, level):
    return h & (4 ** level - 1) == 0


def band(texts):
    every, short = Counter(), Counter()
    n_short = 0
    for t in texts:
        h = terms(t)
        every.update(h)
        if level_of(h) == 0:
            n_short += 1
            short.update(h)
    out = set()
    for h in every:
        n, most = (every[h], len(texts)) if on(h, 1) else (short[h], n_short)
        if imatch.MIN_DOCS <= n <= max(most * imatch.MAX_SHARE, imatch.MIN_DOCS):
            out.add(h)
    return out


def plain_print(text, words):
    every = terms(text)
    level = level_of(every)
    own = [h for h in every if on(h, level) and h in words]
    if not own:
        return f"-:{(hash64(*every) if every else hash64(text)) & (1 << 64) - 1:016x}"
    rows = []
    for k in (level, level + 1):
        row = ""
        for s in range(imatch.SUBSETS):
            part = [h for h in own if on(h, k) and (h & (1 << 64) - 1) >> imatch.SUBSET_SHIFT & imatch.SUBSETS - 1 == s]
            row += f"{1 + hash64(*part) % 65535 if part else 0:04x}"
        rows.append(row)
    return f"{level:x}:{rows[0]}:{rows[1]}"


def plain_likeness(f, g):
    if f == g:
        return 1.0
    if "-" in (f[0], g[0]) or abs(int(f[0], 16) - int(g[0], 16)) > 1:
        return 0.0
    use = max(f[0], g[0])
    a, b = ((x.split(":")[1 + int(use, 16) - int(x[0], 16)]) for x in (f, g))
    pairs = [(a[i:i + 4], b[i:i + 4]) for i in range(0, len(a), 4)]
    either = [p for p in pairs if p != ("0000", "0000")]
    return sum(x == y for x, y in either) / len(either) if either else 0.0


def plain(docs):
    docs = [(d, t or "") for d, t in docs]
    words = band([t for _, t in docs])
    # Equal ids: by the hash of id and text, the larger first.
    key = lambda r: (r[0] is not None, r[0] or 0, hash64(*([r[0]] if r[0] is not None else []), r[1]))
    order = sorted(docs, key=key, reverse=True)
    out = []
    for i, (d, t) in enumerate(order):
        nxt = order[(i + 1) % len(order)][1]
        third = len(t) // 3
        new = t[:len(t) - third] + nxt[:third]
        f, g, n = (plain_print(x, words) for x in (t, new, nxt))
        out.append((d, len(t), hashlib.sha256(new.encode()).hexdigest(), f, g, plain_likeness(f, g), plain_likeness(f, n)))
    return out


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def same(found, expected):
    expected = sorted(expected, key=repr)
    assert len(found) == len(expected)
    for a, b in zip(found, expected):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:]), (a, b)


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_hard_cases(spark, edge_rows, parts):
    docs = [(r[0], r[1]) for r in edge_rows] + [(4, "ties of an id"), (4, "another text"), (None, "no id"), (None, None), (7, "same"), (7, "same")]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        same(rows(imatch.compare_next(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4))), plain(docs))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_query_small_tables(spark, sf, small_rows):
    found = rows(QUERIES["op13_imatch"](spark, sf))
    same(found, plain(small_rows))
    edited, following = [r[5] for r in found], [r[6] for r in found]
    assert sum(a > b for a, b in zip(edited, following)) > 0.9 * len(found)


def test_few_rows_and_other_columns(spark):
    one = spark.createDataFrame([(3, "only one text here", "x", 0)], "doc_id bigint, text string, node string, part int")
    assert rows(imatch.compare_next(one)) == [r for r in plain([(3, "only one text here")])]
    assert imatch.compare_next(one.limit(0)).count() == 0 and imatch.fingerprints(one.limit(0)).count() == 0
    named = spark.createDataFrame([("b", "x y z"), ("a", "x y z"), (None, "q")], "name string, body string")
    found = imatch.compare_next(named, "name", "body")
    assert [(r[0], r[6]) for r in rows(found)] == [("a", 0.0), ("b", 1.0), (None, 0.0)]


def test_slips_change_little_and_equal_texts_nothing(spark):
    """Fingerprints of a text with a misspelled word, of a copy, and of another one of the same words."""
    r = random.Random(3)
    vocabulary = [f"w{i}" for i in range(40_000)]
    base = [" ".join(r.sample(vocabulary, n)) for n in (12, 60, 200, 900, 2500) for _ in range(20)]
    slips = [t.replace(" ", " slip%d " % i, 1) for i, t in enumerate(base)]
    docs = list(enumerate([*base, *slips, *base]))
    prints = imatch.fingerprints(spark.createDataFrame(docs, "doc_id bigint, text string"))
    by_id = {r[0]: r[1] for r in prints.collect()}
    n = len(base)
    assert all(by_id[i] == by_id[2 * n + i] for i in range(n))
    # A slip is no term of the lexicon; it can only carry a text over to the next level.
    assert sum(by_id[i] == by_id[n + i] for i in range(n)) >= 0.9 * n
    pairs = spark.createDataFrame([(by_id[i], by_id[j]) for i in range(0, n, 7) for j in range(n) if i != j], "f string, g string")
    assert pairs.agg(F.avg(imatch.likeness(F.col("f"), F.col("g")))).first()[0] < 0.1
