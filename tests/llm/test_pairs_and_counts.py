"""Near duplicates and token attribution against plain versions."""

import brute
import numpy as np
import pytest

from chorale.llm import jaccard, token_attribution
from chorale.llm.queries import QUERIES


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_components_hard_cases(spark, edge_dir, edge_rows):
    assert rows(QUERIES["op3_jaccard"](spark, edge_dir)) == sorted(brute.components([(r[0], r[1]) for r in edge_rows]))


def test_components_small_tables(spark, sf, small_rows):
    assert rows(QUERIES["op3_jaccard"](spark, sf)) == sorted(brute.components(small_rows))


@pytest.mark.parametrize("tile", [2048, 3])
def test_five_words_and_tiles(spark, edge_docs, edge_rows, monkeypatch, tile):
    """With small tiles, groups are compared tile by tile; the result is the same."""
    monkeypatch.setattr(jaccard, "TILE", tile)
    found = jaccard.near_duplicates(edge_docs, shingle=5, percent=80)
    assert rows(found.select("doc_id", "n_shingles", "component_id")) == sorted(
        brute.components([(r[0], r[1]) for r in edge_rows], 5, 80))
    assert found.filter("stays").select("component_id").distinct().count() == found.filter("stays").count()


@pytest.mark.parametrize("percent", [50, 30])
def test_sets_several_bands_apart(spark, percent):
    """Linked sets whose sizes lie two or more bands apart share a block for any percent."""
    sizes = {50: (28, 16), 30: (40, 13)}[percent]
    words = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(words[:n + 2])) for i, n in enumerate(sizes)] + [(9, "something else than that")]
    found = jaccard.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string"), shingle=3, percent=percent)
    assert rows(found.select("doc_id", "n_shingles", "component_id")) == sorted(brute.components(docs, 3, percent))
    large, small = (np.unique(np.random.default_rng(7).integers(0, 1 << 63, 40, dtype=np.uint64))[:n] for n in sizes)
    assert set(jaccard.blocks(large, percent).tolist()) & set(jaccard.blocks(small, percent).tolist())


def unlinked_copies(g):
    """Texts of one base, each with about a tenth of its words replaced: most pairs share blocks, hardly any is linked at 80 %."""
    r = np.random.default_rng(5)
    base = [f"w{i}" for i in range(400)]
    docs = []
    for d in range(g):
        words = list(base)
        for k in r.choice(400, 14, replace=False):
            words[k] = f"x{d}-{k}"
        docs.append((d, " ".join(words)))
    return docs


def test_rows_grow_with_the_copies_and_not_their_square(spark, monkeypatch):
    put, seen = jaccard.materialise, {}

    def watched(df, name):
        out = put(df, name)
        if name in ("jaccard-tried", "jaccard-links"):
            seen[g] = seen.get(g, 0) + out.count()
        return out

    monkeypatch.setattr(jaccard, "materialise", watched)
    for g in (80, 160):
        docs = unlinked_copies(g)
        found = jaccard.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string"))
        assert rows(found.select("doc_id", "n_shingles", "component_id")) == sorted(brute.components(docs, 5, 80))
    assert seen[160] / 160 <= 1.3 * seen[80] / 80, seen


def test_spanning_pairs_join_what_can_be_joined():
    r = np.random.default_rng(1)
    for _ in range(60):
        g = int(r.integers(2, 30))
        roots = r.integers(0, g, g)
        d = np.full((g, g), jaccard.FAR, dtype=np.uint16)
        for _ in range(int(r.integers(0, 40))):
            a, b = r.integers(0, g, 2)
            if roots[a] != roots[b]:
                d[a, b] = d[b, a] = r.integers(0, 9)

        def parts(pairs):
            label = roots.copy()
            for a, b in pairs:
                label[label == label[a]] = label[b]
            return len(set(label.tolist()))

        pairs = jaccard.spanning_pairs(roots, d)
        assert len(pairs) < len(set(roots.tolist())) and all(d[a, b] != jaccard.FAR for a, b in pairs)
        assert parts(pairs) == parts(np.argwhere(d != jaccard.FAR).tolist())


@pytest.mark.parametrize("percent", [0, 101])
def test_percent_is_checked(edge_docs, percent):
    with pytest.raises(ValueError):
        jaccard.near_duplicates(edge_docs, percent=percent)


def test_pigeonhole_and_sketch_bounds():
    r = np.random.default_rng(3)
    for _ in range(200):
        a = np.unique(r.integers(0, 1 << 63, r.integers(1, 400), dtype=np.uint64))
        gone = r.random(len(a)) < r.random() / 8
        b = np.unique(np.concatenate([a[~gone], r.integers(0, 1 << 63, r.integers(0, len(a) // 10 + 1), dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        size = min(len(jaccard.bit_sketch(a)), len(jaccard.bit_sketch(b)))
        bits = np.unpackbits(jaccard.fold(jaccard.bit_sketch(a), size) ^ jaccard.fold(jaccard.bit_sketch(b), size)).sum()
        assert bits <= len(a) + len(b) - 2 * both
        for p in (80, 90):
            if len(b) and jaccard.linked(len(a), len(b), both, p):
                assert set(jaccard.blocks(a, p).tolist()) & set(jaccard.blocks(b, p).tolist())


def test_drop_near_duplicates_keeps_columns_and_one_of_each(spark, edge_docs):
    clash = edge_docs.withColumnRenamed("lang", "class").withColumnRenamed("n_chars", "root").withColumn("stays", edge_docs.doc_id)
    twice = clash.unionByName(clash)
    kept = jaccard.drop_near_duplicates(twice)
    assert kept.columns == twice.columns
    found = jaccard.near_duplicates(edge_docs)
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == sorted(
        r[0] for r in found.filter("stays").select("doc_id").collect())


@pytest.mark.parametrize("rule", token_attribution.RULES)
def test_token_counts(edge_docs, edge_rows, rule):
    found = token_attribution.token_counts(edge_docs, crossing=rule).drop("name")
    expected = brute.op7([(r[0], r[1], r[2], r[3]) for r in edge_rows], rule)
    assert [(*r[:3], round(r[3], 9), r[4]) for r in rows(found)] == sorted((*r[:3], round(r[3], 9), r[4]) for r in expected)


def test_token_counts_small_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    expected = brute.op7([tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()])
    assert rows(QUERIES["op7_token_counts"](spark, sf).drop("name")) == sorted(expected)


def test_empty_table(spark, edge_docs):
    none = edge_docs.limit(0)
    assert jaccard.near_duplicates(none).count() == 0
    assert jaccard.drop_near_duplicates(none).count() == 0
    assert token_attribution.token_counts(none).count() == 0
