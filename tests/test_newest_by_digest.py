"""The newest of several landings is found without moving the texts of all of them."""

from frames import plan
from pyspark.sql import functions as F

from chorale.operators import silver

COLUMNS = "comment_id string, author string, text string, like_count bigint, ingested_at string"


def newest(rows):
    """The greatest row of each id by stamp and then by the other columns, NULLs least; rows without id stay."""
    key = lambda r: [(v is not None, v) if v is not None else (False,) for v in (r[4], r[1], r[2], r[3])]
    best = {}
    for r in rows:
        if r[0] is not None and (r[0] not in best or key(r) > key(best[r[0]])):
            best[r[0]] = r
    return sorted([*best.values(), *[r for r in rows if r[0] is None]], key=repr)


def test_ties_stamps_and_missing_values(spark):
    rows = [(f"c{i % 7}", ("x", None, "y")[i % 3], (None, f"t{i * 7 % 5}", f"text {i}")[i % 4 % 3], i % 2, (None, "1", "2")[i // 5 % 3]) for i in range(60)]
    rows += [("tie", "a", f"t{i}", i % 3, "9") for i in range(40)] + [("null", "a", None, 1, "1"), ("null", "a", "b", 0, "1")]
    rows += [("once", None, None, None, None), (None, "n", "n", 1, "1"), (None, "n", "n", 1, "1"), ("same", "s", "s", 2, "3"), ("same", "s", "s", 2, "3")]
    df = spark.createDataFrame(rows, COLUMNS)
    found = silver.latest_per_comment(df.repartition(5))
    assert found.columns == df.columns
    assert sorted((tuple(r) for r in found.collect()), key=repr) == newest(rows)


def test_copies_are_dealt_without_their_texts(spark):
    """No shuffle by comment carries a text, and each different text is moved once per task."""
    rows = spark.range(4000).select(
        F.concat(F.lit("c"), (F.col("id") % 2000).cast("string")).alias("comment_id"), F.lit("a").alias("author"),
        F.concat(F.lit("text "), (F.col("id") % 10).cast("string")).alias("text"), F.lit(1).cast("bigint").alias("like_count"),
        (F.col("id") >= 2000).cast("string").alias("ingested_at"))
    found = silver.latest_per_comment(rows)
    assert not [x for x in plan(found).splitlines() if "Exchange hashpartitioning(comment_id" in x]
    assert found.count() == 2000 and found.filter("ingested_at = 'true'").count() == 2000
