"""I-Match fingerprints: what documents share of a corpus's mid-frequency terms.  Column expressions and joins only.

*Terms* are runs of letters and digits in lower case, as 64-bit hashes (seeded).  A term counts if it lies in a band of
inverse document frequency: in at least ``min_docs`` documents (rarer ones are slips and names) and in at most
``max_share`` of them.  Such terms are the lexicon.  Every term of every document is counted, and every one in the band is looked at.

*Lexicon subsets*: hash bits deal the lexicon at random into ``SUBSETS`` subsets.  The terms a document has of each subset,
sorted, are hashed.  A fingerprint is ``0:``, the row of these hashes, and a coarser row, of the quarter of the terms whose
hash ends in two zero bits.  Two documents compare by the share of subsets with equal hashes in the first row, among those that either has terms in.

*What is shuffled*: terms to be counted, combined before; with them goes one document that holds the term.  Terms outside
the band are few (those in more than ``max_share`` of the documents are at most ``1 / max_share`` times the terms of a mean document) or
in one document, which is known from the count (``MIN_DOCS`` is 2).  So each document finds its terms of the lexicon by what it lacks, and only
words made by a cut, which are in no text beside it, are looked up.  With a lexicon that is given, all terms are.

*Edited texts* (``compare_next``) need the next document.  Documents are dealt by ranges of (id, hash of id and text), of which
only the bounds, one a range, are known to the driver; the last document of each range is also put in front of the next
one, so the window over a range has every neighbour and texts are shuffled once.

Defined results: null is empty text; a text without terms of the lexicon has the hash of all its terms, or of the text if
there are none, for a fingerprint, and is like none but its equals (likeness 1); a null id comes last in descending order; equal ids
are ordered by a hash of the text; repeated rows follow each other and each has a row of the result; a single document is
its own neighbour; an empty table gives no rows; very long texts are read whole; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chorale.llm.common import row_key, text_or_empty
from chorale.session import materialise

TERM = r"[\p{L}\p{N}]+"
SUBSETS = 64
#: Terms of a text that are looked at: as many as an array can hold.
MOST_TERMS = (1 << 31) - 1
MIN_DOCS, MAX_SHARE, SEED = 2, 0.05, 13
#: Hash bits that choose the subset; those that choose the coarser row are the lowest.
SUBSET_SHIFT, COARSE = 40, 3
DIGITS = 4  # hex digits of a subset's hash; zeros where it is empty
#: Bytes of texts in a range of ids, which one task sorts (and spills, if need be).
RANGE_BYTES = 256 << 20


def _bound(value: Column, f) -> Column:
    """``f`` of the value, which is worked out once."""
    return F.transform(F.array(value), f)[0]


def term_hashes(text: Column, seed: int = SEED) -> Column:
    """Sorted hashes of the different terms."""
    words = F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))
    return F.array_sort(F.array_distinct(F.transform(words, lambda w: F.xxhash64(F.lit(seed), w))))


def whole_hash(hashes: Column, text: Column) -> Column:
    """Hash of all terms, or of a text without any."""
    return F.when(F.size(hashes) > 0, F.xxhash64(hashes)).otherwise(F.xxhash64(text))


def _counts(docs: DataFrame, id_col: str, text_col: str, seed: int) -> DataFrame:
    """term (hash), n_docs, and of a term that is in one document its ``doc_id`` and ``row`` (``row_key``), as a written table."""
    owned = docs.select(text_or_empty(text_col).alias("text"), F.col(id_col).alias("doc_id")).withColumn("row", row_key("doc_id", "text"))
    owned = owned.select("doc_id", "row", F.explode(term_hashes(F.col("text"), seed)).alias("term"))
    return materialise(owned.groupBy("term").agg(
        F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("doc_id"), F.min("row").alias("row")), "imatch-counts")


def _most(docs: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE) -> float:
    # In a small table every term is in a large share of the documents: the band is never narrower than its lower end.
    return max(docs.count() * max_share, float(min_docs))


def _band(counts: DataFrame, most: float, min_docs: int = MIN_DOCS) -> DataFrame:
    return counts.filter((F.col("n_docs") >= min_docs) & (F.col("n_docs") <= most)).select("term", "n_docs")


def lexicon(docs: DataFrame, text_col: str = "text", min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE, seed: int = SEED) -> DataFrame:
    """term (hash), n_docs: the terms within the band, as a written table."""
    return _band(_counts(docs, text_col, text_col, seed), _most(docs, min_docs, max_share), min_docs)


def _row(terms: Column) -> Column:
    """The hashes of all subsets of the (sorted) terms, one after the other."""
    subset = lambda h: F.shiftrightunsigned(h, SUBSET_SHIFT).bitwiseAND(F.lit(SUBSETS - 1).cast("bigint"))
    dealt = F.array_sort(F.transform(terms, lambda h: F.struct(subset(h).alias("s"), h.alias("h"))))
    # Subsets follow each other, so each is a slice, whose ends are the first places of its number from either side.
    sides = _bound(dealt, lambda d: F.struct(
        d.getField("h").alias("h"), d.getField("s").alias("s"), F.reverse(d.getField("s")).alias("r"), F.size(d).cast("bigint").alias("n")))

    def one(d: Column, s: Column) -> Column:
        own = _bound(F.array_position(d["s"], s), lambda i: F.when(i > 0, F.slice(
            d["h"], i.cast("int"), (d["n"] - F.array_position(d["r"], s) + 2 - i).cast("int"))))
        code = _bound(own, lambda v: F.when(v.isNotNull(), 1 + F.pmod(F.xxhash64(v), F.lit(16 ** DIGITS - 1))).otherwise(0))
        return F.lpad(F.lower(F.hex(code)), DIGITS, "0")

    every = F.sequence(F.lit(0).cast("bigint"), F.lit(SUBSETS - 1).cast("bigint"))
    return _bound(sides, lambda d: F.array_join(F.transform(every, lambda s: one(d, s)), ""))


def fingerprint(terms: Column, whole: Column) -> Column:
    """``terms``: those of the lexicon, sorted."""
    coarse = F.filter(terms, lambda h: h.bitwiseAND(F.lit(COARSE).cast("bigint")) == 0)
    return F.when(F.size(terms) > 0, F.concat_ws(":", F.lit("0"), _row(terms), _row(coarse))).otherwise(
        F.concat(F.lit("-:"), F.lpad(F.lower(F.hex(whole)), 16, "0")))


def likeness(f: Column, g: Column) -> Column:
    """0 to 1: the share of lexicon subsets in which two fingerprints agree."""
    rows = [F.substring(x, 3, SUBSETS * DIGITS) for x in (f, g)]

    def count(pair: Column) -> Column:
        part = lambda x, s: F.substring(x, s * DIGITS + 1, F.lit(DIGITS))
        empty = "0" * DIGITS
        states = F.transform(F.sequence(F.lit(0), F.lit(SUBSETS - 1)), lambda s: F.when(
            part(pair["a"], s) != part(pair["b"], s), 1).when(part(pair["a"], s) != empty, 2).otherwise(0))
        return _bound(states, lambda v: F.size(F.filter(v, lambda x: x == 2)) / F.greatest(F.size(F.filter(v, lambda x: x > 0)), F.lit(1)))

    shared = F.startswith(f, F.lit("0")) & F.startswith(g, F.lit("0"))  # others have no terms of the lexicon
    alike = F.when(shared, _bound(F.struct(rows[0].alias("a"), rows[1].alias("b")), count)).otherwise(0.0)
    return F.when(f == g, 1.0).otherwise(alike).cast("double")


def _none() -> Column:
    return F.array().cast("array<bigint>")


def _or_none(c: Column) -> Column:
    return F.coalesce(c, _none())


class _Own:
    """The lexicon of the documents themselves, by what is outside of it: ``common`` terms, and ``rare`` ones (``doc_id, row, rare``) of their document."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, seed: int):
        counts, most = _counts(docs, id_col, text_col, seed), _most(docs)
        self.words = _band(counts, most)
        self.common = [r["term"] for r in counts.filter(F.col("n_docs") > most).select("term").collect()]
        self.rare = counts.filter(F.col("n_docs") < MIN_DOCS).groupBy("doc_id", "row").agg(F.collect_list("term").alias("rare"))

    def without_common(self, hashes: Column) -> Column:
        return F.filter(hashes, lambda h: ~h.isin(self.common)) if self.common else hashes


def _looked_up(rows: DataFrame, asked: str, words: DataFrame) -> DataFrame:
    """``rows`` (a written table with a ``node``) with the terms of the array ``asked`` that are words, sorted, in its place."""
    terms = rows.select("node", F.explode(asked).alias("term"))
    # Merged at every size, as both sides grow with the corpus.
    known = terms.join(words.select("term").hint("merge"), "term")
    of = known.groupBy(F.col("node").alias("_node")).agg(F.sort_array(F.collect_list("term")).alias("_known"))
    joined = rows.drop(asked).join(of.hint("merge"), F.col("node") == F.col("_node"), "left")
    return joined.withColumn(asked, _or_none(F.col("_known"))).drop("_node", "_known")


def _printed(terms: Column, whole: Column) -> Column:
    return _bound(terms, lambda t: fingerprint(t, whole))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: DataFrame | None = None, seed: int = SEED) -> DataFrame:
    """doc_id, fingerprint; ``words`` is the lexicon (of these documents, if none is given)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    if words is None:
        own = _Own(docs, id_col, text_col, seed)
        rows = rows.withColumn("row", row_key("doc_id", "text"))
        rare = own.rare.select(F.col("row").alias("_row"), "rare").groupBy("_row").agg(F.flatten(F.collect_list("rare")).alias("rare"))
        rows = rows.join(rare.hint("merge"), F.col("row") == F.col("_row"), "left")
        parts = rows.select("doc_id", "rare", F.col("text"), term_hashes(F.col("text"), seed).alias("every"))
        parts = parts.select("doc_id", whole_hash(F.col("every"), F.col("text")).alias("whole"), F.array_except(
            own.without_common(F.col("every")), _or_none(F.col("rare"))).alias("terms"))
    else:
        parts = rows.select(F.monotonically_increasing_id().alias("node"), "doc_id", "text", term_hashes(F.col("text"), seed).alias("terms"))
        parts = parts.select("node", "doc_id", whole_hash(F.col("terms"), F.col("text")).alias("whole"), "terms")
        parts = _looked_up(materialise(parts, "imatch-terms"), "terms", words)
    return parts.select("doc_id", _printed(F.col("terms"), F.col("whole")).alias("fingerprint"))


def with_next(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rare: DataFrame | None = None, more: dict[str, Column] | None = None
) -> DataFrame:
    """node, doc_id, text, next_text, ghost, and ``more`` columns with their ``next_`` ones: each document with the next one in descending order of ids (the first behind the last).

    ``more`` are made of ``text`` and of ``rare``, the list that the table of that name (``doc_id, row, rare``) has for the document: it
    is dealt as documents are, so texts are shuffled once.
    The next document of a row has the node below; a *ghost* is the last document of the range before, which has that place.
    """
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).withColumn("row", row_key("doc_id", "text"))
    # Ascending order with nulls first, looking backwards, is descending order with nulls last.
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / RANGE_BYTES))
    ranges = rows.select("doc_id", "row").repartitionByRange(ranges, "doc_id", "row")
    place = F.struct("doc_id", "row")
    ends = materialise(ranges.select(place.alias("place"), F.spark_partition_id().alias("part")).groupBy("part").agg(
        F.max("place").alias("last")), "imatch-ranges")
    ends = ends.agg(F.sort_array(F.collect_list("last")).alias("ends")).first()["ends"]  # one for each partition
    n, kind = len(ends), f"array<{rows.select(place.alias('p')).schema['p'].dataType.simpleString()}>"

    def literal(some: list) -> Column:
        return F.array(*[F.struct(F.lit(e["doc_id"]).alias("doc_id"), F.lit(e["row"]).alias("row")) for e in some]).cast(kind)

    # Ranges that end before the document, counted by blocks of bounds and then in one block.  Documents that came in
    # behind the last bound belong to the last range.
    known, block = literal(ends), max(1, math.isqrt(n))
    before = lambda some: F.size(F.filter(some, lambda e: e < place))
    blocks = before(literal(ends[block - 1::block]))
    part = F.least(_bound(blocks, lambda b: b * block + before(F.slice(known, b * block + 1, F.lit(block)))), F.lit(max(n - 1, 0)))
    if rare is not None:
        rows = rows.withColumn("rare", F.lit(None).cast("array<bigint>")).unionByName(rare, allowMissingColumns=True)
    kept = rows.columns
    placed = rows.withColumn("part", part)
    last = F.element_at(known, F.col("part") + 1) == place
    copies = F.when(last, F.array(F.struct(F.col("part").alias("part"), F.lit(False).alias("ghost")),
                                  F.struct(((F.col("part") + 1) % max(n, 1)).cast("int").alias("part"), F.lit(True).alias("ghost")))).otherwise(
        F.array(F.struct(F.col("part").alias("part"), F.lit(False).alias("ghost"))))
    dealt = placed.select(*kept, F.explode(copies).alias("c")).select(*kept, "c.part", "c.ghost").repartition("part")
    place = [F.col("ghost").desc(), F.col("doc_id").asc_nulls_first(), F.col("row")]
    if rare is not None:  # the list stands in front of its document
        listed = F.last(F.when(F.col("rare").isNotNull(), F.struct("doc_id", "row", "rare", "ghost")), ignorenulls=True).over(
            Window.partitionBy("part").orderBy(*place, F.col("text").isNotNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow))
        own = F.col("l.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("l.row") == F.col("row")) & (F.col("l.ghost") == F.col("ghost"))
        dealt = dealt.withColumn("l", listed).filter(F.col("text").isNotNull()).withColumn("rare", F.when(own, F.col("l.rare"))).drop("l")
    for name, made in (more or {}).items():  # after the shuffle, which carries texts and lists of rare terms
        dealt = dealt.withColumn(name, made)
    order = Window.partitionBy("part").orderBy(*place)
    number = F.row_number().over(order).cast("bigint")
    own = ["text", *(more or {})]
    rows = dealt.select((F.shiftleft(F.col("part").cast("bigint"), 40) + number).alias("node"), "doc_id", "ghost", *own,
                        F.lag(F.struct(*own)).over(order).alias("next"))
    return rows.select("node", "doc_id", *own, *[F.col(f"next.{c}").alias(f"next_{c}") for c in own], "ghost")


def edited(text: Column, next_text: Column) -> Column:
    """The last third of the text replaced by as much of the start of the next one."""
    third = F.floor(F.char_length(text) / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - third), F.substring(next_text, F.lit(1), third))


def compare_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: DataFrame | None = None, seed: int = SEED) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    text, hashed = F.col("text"), lambda c: term_hashes(F.col(c), seed)
    own = _Own(docs, id_col, text_col, seed) if words is None else None
    if own:
        parts = _bound(hashed("text"), lambda h: F.struct(
            whole_hash(h, text).alias("whole"), F.array_except(own.without_common(h), F.col("rare")).alias("terms")))
        rows = with_next(docs, id_col, text_col, own.rare, {"rare": _or_none(F.col("rare")), "own": parts})
    else:
        parts = _bound(hashed("text"), lambda h: F.struct(whole_hash(h, text).alias("whole"), h.alias("terms")))
        rows = with_next(docs, id_col, text_col).withColumn("own", parts)
    rows = rows.withColumn("edited", edited(text, F.coalesce("next_text", F.lit("")))).withColumn("new", _bound(hashed("edited"), lambda h: F.struct(
        whole_hash(h, F.col("edited")).alias("whole"), (own.without_common(h) if own else h).alias("terms"))))
    shown = ["node", "doc_id", "ghost", F.char_length("text").cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
             F.col("new.whole").alias("new_whole")]
    if own:
        near = F.array_union("own.terms", _or_none(F.col("next_own.terms")))
        seen = F.array_union(near, F.array_union("rare", _or_none(F.col("next_rare"))))
        # Terms of either text are known by it; others come from words that the edit has cut.
        rows = rows.select(*shown, _printed(F.col("own.terms"), F.col("own.whole")).alias("own_print"),
                           F.array_intersect("new.terms", near).alias("new"), F.array_except("new.terms", seen).alias("asked"))
        done = _looked_up(materialise(rows, "imatch-sketches"), "asked", own.words)
        new = F.array_sort(F.array_union("new", "asked"))
    else:
        rows = rows.select(*shown, F.col("own.whole").alias("own_whole"), F.col("own.terms").alias("own"), F.col("new.terms").alias("new"),
                           F.array_union("own.terms", "new.terms").alias("asked"))
        done = _looked_up(materialise(rows, "imatch-sketches"), "asked", words)
        done = done.withColumn("own_print", _printed(F.array_intersect("own", "asked"), F.col("own_whole")))
        new = F.array_intersect("new", "asked")
    done = done.withColumn("new_print", _printed(new, F.col("new_whole")))
    below = done.select((F.col("node") + 1).alias("_above"), F.col("own_print").alias("next_print"))
    both = done.filter(~F.col("ghost")).join(below.hint("merge"), F.col("node") == F.col("_above"))
    return both.select(
        "doc_id", "n_chars", "edited_sha256", F.col("own_print").alias("fingerprint"), F.col("new_print").alias("edited_fingerprint"),
        likeness(F.col("own_print"), F.col("new_print")).alias("near_edited"),
        likeness(F.col("own_print"), F.col("next_print")).alias("near_next"))
