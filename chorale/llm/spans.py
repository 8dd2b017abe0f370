"""Places of pattern matches as column expressions: no Python on the executors.

Spark's functions give matches without their places.  Cutting the text at the matches gives the pieces between them, and
the running sum of the lengths of pieces and matches gives the places (code points, end exclusive).  Sums run in blocks,
so a text with many matches costs its number of matches and not its square.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = 256
SPAN = "struct<start:int,end:int,rank:int,kind:string,value:string>"


def _total(x: Column) -> Column:
    return F.aggregate(x, F.lit(0), lambda a, v: a + v)


def _running(steps: Column) -> Column:
    """Sum of all steps before each step."""
    blocks = F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / BLOCK).cast("int"))
    part = lambda b: F.slice(steps, b * BLOCK + 1, F.lit(BLOCK))
    sums = F.transform(blocks, lambda b: _total(part(b)))

    def inside(b: Column) -> Column:
        start = F.struct(F.aggregate(F.slice(sums, F.lit(1), b), F.lit(0), lambda a, v: a + v).alias("at"),
                         F.array().cast("array<int>").alias("out"))
        return F.aggregate(
            part(b), start,
            lambda a, v: F.struct((a["at"] + v).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")),
            lambda a: a["out"])

    return F.flatten(F.transform(blocks, inside))


def find(
    text: Column, pattern: str, kind: str, rank: int, needs: Column,
    keep: Callable[[Column], Column] | None = None, measure: int | None = None,
) -> Column:
    """Spans of the matches of ``pattern`` for which ``keep`` holds; nothing else is looked at where ``needs`` fails.

    ``keep`` gets the match, or the group ``measure`` of it.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    judged = F.regexp_extract_all(text, F.lit(pattern), F.lit(measure)) if measure else matches
    both = F.zip_with(F.zip_with(F.slice(pieces, F.lit(1), F.size(matches)), matches,
                                 lambda p, m: F.struct(F.char_length(p).alias("p"), F.char_length(m).alias("m"), m.alias("value"))),
                      judged, lambda x, j: F.struct(x["p"].alias("p"), x["m"].alias("m"), x["value"].alias("value"), j.alias("judged")))
    steps = F.transform(both, lambda x: x["p"] + x["m"])
    placed = F.zip_with(both, _running(steps), lambda x, at: F.struct(
        (at + x["p"]).alias("start"), (at + x["p"] + x["m"]).alias("end"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"),
        x["value"].alias("value"), x["judged"].alias("judged")))
    if keep is not None:
        placed = F.filter(placed, lambda x: keep(x["judged"]))
    plain = F.transform(placed, lambda x: F.struct(x["start"], x["end"], x["rank"], x["kind"], x["value"]))
    return F.when(needs & text.rlike(pattern), plain).otherwise(F.array()).cast(f"array<{SPAN}>")


def joined(spans: Column) -> Column:
    """kind:start:end, joined by commas in the order of the array."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def by_start(spans: Column) -> Column:
    """Sorted by start, then kind: the leading fields of a span are start, end and rank, and spans of a kind never overlap."""
    order = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"),
                                                  s["kind"].alias("kind"), s["value"].alias("value")))
    return F.transform(F.array_sort(order), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["rank"].alias("rank"), s["kind"].alias("kind"), s["value"].alias("value")))


def by_kind(spans: Column) -> Column:
    order = F.transform(spans, lambda s: F.struct(s["rank"].alias("rank"), s["start"].alias("start"), s["end"].alias("end"),
                                                  s["kind"].alias("kind"), s["value"].alias("value")))
    return F.transform(F.array_sort(order), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["rank"].alias("rank"), s["kind"].alias("kind"), s["value"].alias("value")))


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def overlaps(a: Column, others: Column) -> Column:
    return F.exists(others, lambda o: (o["start"] < a["end"]) & (a["start"] < o["end"]))
