"""Which rows the filtering operators keep, whatever the columns are called; the directory of exact copies."""

import brute
import pytest
from pyspark.sql import functions as F

from chorale.llm import exact_dedup, jaccard, mixing


@pytest.mark.parametrize("drop", [exact_dedup.drop_exact_duplicates, jaccard.drop_near_duplicates, mixing.take_mixed])
def test_columns_of_any_name_come_out_as_they_went_in(spark, drop):
    names = ["__row", "doc", "own_id", "own_row", "kept_id", "kept_row", "times", "copies", "n_rows", "taken_id"]
    text = "some words that are long enough to be a set of shingles of their own number"
    rows = [(i, f"{text} {i} {i * 7} {i * 11}", "s", *[i * 100 + k for k in range(len(names))]) for i in range(8)]
    docs = spark.createDataFrame([*rows, rows[3]], "doc_id bigint, text string, source string, " + ", ".join(f"{n} bigint" for n in names))
    out = drop(docs)
    assert out.columns == docs.columns
    by_id = {r[0]: tuple(r) for r in out.collect()}
    assert by_id and all(v == next(r for r in rows if r[0] == k) for k, v in by_id.items())


@pytest.mark.parametrize("drop", [exact_dedup.drop_exact_duplicates, jaccard.drop_near_duplicates])
def test_of_equal_ids_and_texts_the_same_row_stays(spark, drop):
    rows = [(1, "the very same text of this id", f"s{i}") for i in range(20)] + [(2, "another one", "x")]
    kept = set()
    for n in (1, 3, 7):
        docs = spark.createDataFrame(rows[::-1] if n == 3 else rows, "doc_id bigint, text string, source string").repartition(n)
        kept.add(tuple(sorted(tuple(r) for r in drop(docs).collect())))
    assert len(kept) == 1 and len(next(iter(kept))) == 2


@pytest.mark.parametrize("capacity", [1, 3, 10, 10_000])
def test_directory_splits_until_no_bucket_is_overfull(spark, edge_docs, edge_rows, capacity):
    found = exact_dedup.exact_duplicates(edge_docs, capacity=capacity)
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, found.select(*columns).collect())) == sorted(brute.op6([(r[0], r[1]) for r in edge_rows]))
    load = found.groupBy("bucket_depth", "bucket").agg(F.count_distinct("text_sha256").alias("n")).collect()
    assert max(r["n"] for r in load) <= capacity
    assert (len(load) == 1) == (capacity == 10_000)
    if capacity == 3:
        assert len({r["bucket_depth"] for r in load}) > 1
    # The leading bits of a bucket are those of no other: ranges of keys do not overlap.
    names = sorted(format(r["bucket"], f"0{r['bucket_depth']}b") if r["bucket_depth"] else "" for r in load)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:]))
