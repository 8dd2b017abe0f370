"""Connected components of a table of links, by alternating large and small stars.

Every step is a minimum per node (combined before the shuffle) and a join back; no list of neighbours is built, so a node
with any number of links is only narrow rows, which the adaptive skew join splits.  Steps are written tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chorale.session import materialise


def _star(links: DataFrame, large: bool) -> DataFrame:
    """links (u > v): each node's neighbours on one side are tied to the least node it knows."""
    if large:  # both ends look at all their neighbours; larger ones are tied to the least
        both = links.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(links.select(F.col("v").alias("x"), F.col("u").alias("y")))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        tied = both.filter("y > x").join(least, "x").select(F.col("y").alias("u"), F.col("m").alias("v"))
    else:  # the larger end ties its smaller neighbours, and itself, to the least
        least = links.groupBy("u").agg(F.min("v").alias("m"))
        tied = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return tied.filter("u <> v").distinct()


def connected_components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """links (a, b) -> node, root (the least node of its component); nodes without links are not listed."""
    now = materialise(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")

    def state(t: DataFrame):
        return tuple(t.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    before = state(now)
    for _ in range(most_rounds):
        if not before[0]:
            break
        now = materialise(_star(_star(now, True), False), "links")
        after = state(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
