"""Personal data: base patterns, and terms that give away a protected value.  Column expressions and joins only.

*Base* spans are addresses, network addresses, card numbers and phone numbers.  Each value found is a protected entity.

*Disclosure* (information-theoretic sanitisation): over the whole corpus of N documents, with df the number of documents
that hold something, a term t tells about an entity e

    PMI(t; e) = log2(N * df(t, e) / (df(t) * df(e)))      out of      IC(e) = log2(N / df(e))

bits.  A term is disclosing if PMI >= ``threshold`` * IC, seen with at least ``support`` different texts that hold e (one
text and its copies are no evidence).  Terms are all words (cut at white space) of the documents that hold it, at any
distance.  Such a term is generalised to its class (NAME, NUMBER, WORD) if the class itself is not disclosing by the same
measure, and removed otherwise, at every place in the documents that hold the entity.

df(t) is counted over all documents: different words per document are combined before the shuffle.  (term, entity) pairs
are made only of entities with enough support and of terms rare enough outside the documents that hold one, which leaves
out no pair that could pass.  Evidence is gathered per different text, so an entity or text of a third of all documents is
one narrow row.

Defined results: a null text is empty text and has no spans; a null id is kept; repeated rows give repeated rows (they
are the same text); an empty table gives no rows; other columns are not read; long texts are read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chorale.llm import spans as sp
from chorale.llm.common import WORD, text_or_empty
from chorale.session import materialise

# The base patterns.  Possessive repeats and the look-behinds give the same matches without trying again
# inside a run of characters that has failed; \G lets a match follow another one directly.
_LOCAL = "[A-Za-z0-9._%+-]"
EMAIL = rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IP_PART = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
KINDS = ("email", "ip", "card", "phone")

SUPPORT, THRESHOLD = 3, 0.9
WHITE_SPACE = r"[\x20\x09-\x0D]+"


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def _luhn(v: Column) -> Column:
    """13 to 19 digits whose sum, every second one from the right doubled, ends in 0."""
    d = F.reverse(_digits(v))
    n = F.char_length(d)
    values = F.transform(F.split(d, ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)))
    total = F.aggregate(F.when(n.between(13, 19), values), F.lit(0), lambda a, x: a + x)
    return F.coalesce(total % 10 == 0, F.lit(False))


def base_spans(text: Column) -> Column:
    """Spans by kind, then start."""
    some = text.rlike("[0-9]")
    return F.concat(
        sp.find(text, EMAIL, "email", 0, F.contains(text, F.lit("@"))),
        sp.find(text, IP, "ip", 1, some, lambda v: v.rlike(rf"^{IP_PART}(?:\.{IP_PART}){{3}}$")),
        sp.find(text, CARD, "card", 2, some, _luhn),
        sp.find(text, PHONE, "phone", 3, F.contains(text, F.lit("+")), lambda v: F.char_length(_digits(v)).between(9, 15)))


def class_of(term: Column) -> Column:
    """What a term is generalised to, by its first character."""
    return F.when(term.rlike("^[0-9]"), "NUMBER").when(term.rlike(r"^\p{Lu}"), "NAME").otherwise("WORD")


#: Class -> whether a text holds a word of it.
CLASS_IN_TEXT = {"NUMBER": r"(?:^|[\x20\x09-\x0D])[0-9]", "NAME": r"(?:^|[\x20\x09-\x0D])\p{Lu}",
                 "WORD": r"(?:^|[\x20\x09-\x0D])[^\x20\x09-\x0D0-9\p{Lu}]"}


def _entity(span: Column) -> Column:
    return F.concat_ws(":", span["kind"], F.lower(span["value"]))


def _words(text: Column) -> Column:
    """Different words of a text."""
    return F.filter(F.array_distinct(F.split(text, WHITE_SPACE)), lambda w: w != "")


def disclosing(docs: DataFrame, texts: DataFrame, text_col: str, support: int, threshold: float) -> DataFrame:
    """text_key, term, becomes: the terms that tell too much, in the texts that hold such an entity.  ``texts`` has one
    row per different text that holds an entity: text_key, copies, base, text."""
    text = text_or_empty(text_col)
    totals = docs.agg(F.count(F.lit(1)).alias("n"), *[F.sum(text.rlike(p).cast("long")).alias(c) for c, p in CLASS_IN_TEXT.items()]).first()
    size = float(totals["n"] or 1)
    n = F.lit(size)
    told = lambda both, own: F.log2(n * both / (own * F.col("df_e")))
    limit = F.lit(threshold) * F.log2(n / F.col("df_e"))

    # Entities with enough support, and which classes do not give them away.
    held = texts.select("text_key", "copies", F.explode(F.array_distinct(F.transform("base", _entity))).alias("entity"),
                        *[F.when(F.col("text").rlike(p), F.col("copies")).otherwise(0).alias(c) for c, p in CLASS_IN_TEXT.items()])
    entities = held.groupBy("entity").agg(F.sum("copies").alias("df_e"), F.count(F.lit(1)).alias("texts"),
                                          *[F.sum(c).alias(c) for c in CLASS_IN_TEXT])
    entities = materialise(entities.filter((F.col("texts") >= support) & (limit > 0)).select("entity", "df_e", *[
        F.coalesce(told(F.col(c), F.lit(float(totals[c] or 1))) < limit, F.lit(False)).alias(c) for c in CLASS_IN_TEXT]), "pii-entities")
    lowest = entities.agg(F.min("df_e")).first()[0] or 1
    bearers = materialise(held.select("text_key", "entity").join(entities, "entity").groupBy("text_key").agg(
        F.collect_list(F.struct("entity", "df_e", *CLASS_IN_TEXT)).alias("entities")), "pii-bearers")

    # Words of the texts that hold one.  PMI reaches the limit only if df(t, e) >= df(t) * (df(e) / N) ** (1 - threshold),
    # and df(t, e) is at most the documents of these texts that hold t: common words fall out here, none that could pass.
    words = texts.join(bearers.select("text_key"), "text_key", "left_semi").select(
        "text_key", "copies", F.explode(_words(F.col("text"))).alias("term"))
    seen = words.groupBy("term").agg(F.sum("copies").alias("df_any"), F.count(F.lit(1)).alias("texts"))
    # Document counts over the whole corpus, of every word, combined before the shuffle.
    df_term = docs.select(F.explode(_words(text)).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df_t"))
    least = F.lit((lowest / size) ** (1 - threshold) * (1 - 1e-9))
    rare = materialise(seen.filter(F.col("texts") >= support).join(df_term, "term").filter(
        F.col("df_any") >= F.col("df_t") * least).select("term", "df_t"), "pii-rare")
    of_text = words.join(rare, "term").groupBy("text_key", "copies").agg(F.collect_list(F.struct("term", "df_t")).alias("terms"))
    both = materialise(of_text.join(bearers, "text_key"), "pii-pairs")
    each = both.select("text_key", "copies", "terms", F.explode("entities").alias("e")).select(
        "text_key", "copies", "e", F.explode("terms").alias("t")).select("text_key", "copies", "e.*", "t.*")

    of_class = F.col("WORD")
    for c in ("NAME", "NUMBER"):
        of_class = F.when(class_of(F.col("term")) == c, F.col(c)).otherwise(of_class)
    becomes = F.when(of_class, F.concat(F.lit("["), class_of(F.col("term")), F.lit("]"))).otherwise("")
    pairs = each.groupBy("entity", "df_e", *CLASS_IN_TEXT, "term", "df_t").agg(
        F.sum("copies").alias("df_te"), F.count(F.lit(1)).alias("texts"))
    judged = materialise(pairs.filter((F.col("texts") >= support) & (told(F.col("df_te"), F.col("df_t")) >= limit)).select(
        "entity", "term", becomes.alias("becomes")), "pii-judged")
    # Of what several entities ask for, removed if any asks for that.
    return each.select("text_key", "entity", "term").join(judged, ["entity", "term"]).groupBy("text_key", "term").agg(
        F.min("becomes").alias("becomes"))


def find_personal(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: int = SUPPORT, threshold: float = THRESHOLD,
) -> DataFrame:
    """doc_id, text_key (hash of the text), base (spans by kind), added (spans of kind ``term``; their value is what
    the term becomes)."""
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), base_spans(text).alias("base"))
    rows = materialise(rows.select("doc_id", F.xxhash64("text").alias("text_key"), "base",
                                   F.when(F.size("base") > 0, F.col("text")).alias("text")), "pii-spans")
    texts = rows.filter(F.size("base") > 0).groupBy("text_key").agg(
        F.count(F.lit(1)).alias("copies"), F.first("base").alias("base"), F.first("text").alias("text"))
    texts = materialise(texts, "pii-texts")
    told = materialise(disclosing(docs, texts, text_col, support, threshold), "pii-told")
    # Every place of such a term in such a text; words that touch a base span go with it.
    places = sp.find(F.col("text"), WORD, "term", len(KINDS), F.lit(True))
    placed = texts.join(told.select("text_key").distinct(), "text_key", "left_semi").select("text_key", F.explode(places).alias("s"))
    found = placed.withColumn("term", F.col("s.value")).join(told, ["text_key", "term"]).groupBy("text_key").agg(F.collect_list(F.struct(
        "s.start", "s.end", "s.rank", "s.kind", F.col("becomes").alias("value"))).alias("added"))
    found = found.join(texts.select("text_key", "base"), "text_key").select("text_key", F.filter(
        "added", lambda s: ~sp.overlaps(s, F.col("base"))).alias("added"))
    added = materialise(found, "pii-terms")
    nothing = F.array().cast(f"array<{sp.SPAN}>")
    return rows.join(added, "text_key", "left").select(
        "doc_id", "text_key", "base", F.coalesce("added", nothing).cast(f"array<{sp.SPAN}>").alias("added"))


def sanitised(text: Column, base: Column, added: Column) -> Column:
    """The text with every span replaced: base spans by their kind in brackets, terms by what they become."""
    spans = sp.by_start(F.concat(F.transform(base, lambda b: F.struct(
        b["start"].alias("start"), b["end"].alias("end"), b["rank"].alias("rank"), b["kind"].alias("kind"),
        F.concat(F.lit("["), F.upper(b["kind"]), F.lit("]")).alias("value"))), added))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    # Where spans of different kinds overlap, the text between their common start and last end is replaced.
    done = F.aggregate(spans, start, lambda a, s: F.struct(
        F.greatest(a["at"], s["end"]).alias("at"),
        F.concat(a["out"], F.when(s["start"] >= a["at"], F.concat(F.substring(text, a["at"] + 1, s["start"] - a["at"]), s["value"]))
                 .otherwise(F.lit(""))).alias("out")))
    return F.concat(done["out"], F.substring(text, done["at"] + 1, F.char_length(text)))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """doc_id, text without personal data."""
    text = text_or_empty(text_col)
    spans = find_personal(docs, id_col, text_col, **how).filter((F.size("base") > 0) | (F.size("added") > 0))
    per_text = spans.groupBy("text_key").agg(F.first("base").alias("base"), F.first("added").alias("added"))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).withColumn("text_key", F.xxhash64("text"))
    clean = F.when(F.col("base").isNull(), F.col("text")).otherwise(sanitised(F.col("text"), F.col("base"), F.col("added")))
    return rows.join(per_text, "text_key", "left").select("doc_id", clean.alias("text"))


def digests(found: DataFrame) -> DataFrame:
    base, everything = sp.by_kind(F.col("base")), sp.by_kind(F.concat("base", "added"))
    return found.select(
        "doc_id", *[sp.count_kind(F.col("base"), k).alias(f"n_{k}") for k in KINDS],
        F.sha2(sp.joined(base), 256).alias("base_sha256"), sp.joined(everything).alias("spans"))
