"""Secrets in texts: base patterns, and a battery of randomness tests on other strings.  Column expressions only.

*Base* spans: values given to password-like names, access keys, long hexadecimal runs.

*Battery*: every run of 16 or more letters, digits and ``+/_-`` is a candidate.  Its encoding is inferred from the characters
it uses (digits, hexadecimal, letters of one case without or with digits, letters, 62 or 64 characters), and against uniform
random characters of that alphabet it is tested for
  - chi-squared uniformity (one-sided; cube-root transform with the exact mean and variance for the length),
  - runs above and below the middle of the alphabet (two-sided),
  - serial correlation at distance one (two-sided),
  - the likelihood ratio against words: its probability as random characters over that by a model of pairs of letters.  By
    Markov's inequality this is a p-value as it stands.  The model is fitted to the different runs of under 16 characters of
    the whole table, which are never candidates themselves; they are combined per task before they are shuffled.
The p-value is four times the smallest.  All candidates of the corpus are then put through the procedure of Benjamini and
Hochberg with weights proportional to length (a long string has more power, so it gets a larger share of the error):
strings found *not* to be random, at a false-discovery rate of ``rate``, are let go, the others are secrets.  So
of the strings that are let go at most that share was random.  p-values are rounded up to a grid of 1/10 decade,
which leaves 301 counts to look at, however large the corpus is.

Defined results: a null text is empty text and has no spans; a null id is kept; repeated rows give repeated rows; an
empty table gives no rows; other columns are not read; long texts are read whole.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chorale.llm import spans as sp
from chorale.llm.common import text_or_empty
from chorale.session import materialise

# The base patterns and least lengths.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"
ASSIGN_LEAST, ACCESS_LEAST = 6, 20

CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+"
SHORT = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{1,15}+(?![A-Za-z0-9+/_-])"
DIGITS, UP, LOW = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Pattern of a string -> alphabet; the first that fits.
ENCODINGS = [
    ("digits", "^[0-9]+$", DIGITS),
    ("hex", "^[0-9a-f]+$", DIGITS + "abcdef"), ("hex", "^[0-9A-F]+$", DIGITS + "ABCDEF"),
    ("upper26", "^[A-Z]+$", UP), ("lower26", "^[a-z]+$", LOW), ("letters52", "^[A-Za-z]+$", UP + LOW),
    ("upper36", "^[0-9A-Z]+$", DIGITS + UP), ("lower36", "^[0-9a-z]+$", DIGITS + LOW),
    ("base62", "^[0-9A-Za-z]+$", UP + LOW + DIGITS), ("base64", "^[0-9A-Za-z+/]+$", UP + LOW + DIGITS + "+/"),
    ("base64url", "^.*$", UP + LOW + DIGITS + "-_+/"),
]
#: Characters of the model of words, without case.
SYMBOLS = LOW + DIGITS + "+/_-"
#: Chance of the case of a letter after an upper-case letter, a lower-case one, and anything else: (upper, lower).
CASE = ((0.5, 0.5), (0.1, 0.9), (0.5, 0.5))
FALSE_DISCOVERY_RATE = 0.01
GRID, LAST_BIN = 10, 300


def base_spans(text: Column) -> Column:
    assign = sp.find(text, ASSIGN, "assign", 0, F.contains(text, F.lit("=")) | F.contains(text, F.lit(":")),
                     lambda v: F.char_length(v) >= ASSIGN_LEAST, measure=2)
    access = sp.find(text, ACCESS, "access", 1, F.contains(text, F.lit("AKIA")), lambda v: F.char_length(v) >= ACCESS_LEAST)
    return F.concat(assign, access, sp.find(text, HEX, "hex", 2, F.lit(True)))


def _upper_tail(z: Column) -> Column:
    """Normal probability above z (z >= 0), Abramowitz and Stegun 26.2.17: absolute error below 1e-7."""
    t = F.lit(1.0) / (1 + F.lit(0.2316419) * z)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return F.exp(-z * z / 2) / F.sqrt(F.lit(6.283185307179586)) * poly


def _one_sided(z: Column) -> Column:
    return F.when(z >= 0, _upper_tail(z)).otherwise(1 - _upper_tail(-z))


def word_model(docs: DataFrame, text_col: str = "text") -> list[float]:
    """log2 of the chance of each symbol after each symbol (after the start last), in rows of len(SYMBOLS)."""
    size, start = len(SYMBOLS), len(SYMBOLS)
    runs = F.array_distinct(F.regexp_extract_all(text_or_empty(text_col), F.lit(SHORT), F.lit(0)))
    words = docs.select(F.explode(runs).alias("w")).distinct()
    after = F.transform(F.sequence(F.lit(1), F.char_length("w")), lambda i: F.struct(
        F.when(i > 1, F.substring(F.lower("w"), i - 1, F.lit(1))).otherwise("").alias("a"), F.substring(F.lower("w"), i, F.lit(1)).alias("b")))
    seen = words.select(F.explode(after).alias("s")).groupBy("s.a", "s.b").count()
    # At most (size + 1) * size rows come to the driver.
    counts = [[0] * size for _ in range(size + 1)]
    for r in seen.collect():
        counts[SYMBOLS.index(r["a"]) if r["a"] else start][SYMBOLS.index(r["b"])] += r["count"]
    # A tenth is shared out evenly, so that one pair never seen before does not make a word look random.
    return [math.log2(0.9 * (c + 0.5) / (sum(row) + 0.5 * size) + 0.1 / size) for row in counts for c in row]


def battery(value: Column, model: list[float]) -> Column:
    """struct(encoding, p): the inferred encoding of a string and the p-value of its being random."""
    encoding = alphabet = None
    for name, pattern, letters in reversed(ENCODINGS):
        fits = value.rlike(pattern)
        encoding = F.lit(name) if encoding is None else F.when(fits, F.lit(name)).otherwise(encoding)
        alphabet = F.lit(letters) if alphabet is None else F.when(fits, F.lit(letters)).otherwise(alphabet)
    return _tests(F.struct(value.alias("value"), encoding.alias("encoding"), alphabet.alias("alphabet")), model)


def _as_words(value: Column, model: list[float]) -> Column:
    """log2 of the probability of a string by the model of words; the case of letters counts if both cases occur."""
    table = F.split(F.lit(",".join(map(repr, model))), ",").cast("array<double>")
    cases = F.split(F.lit(",".join(repr(math.log2(p)) for row in CASE for p in row)), ",").cast("array<double>")
    mixed = value.rlike("[A-Z]") & value.rlike("[a-z]")

    def step(a: Column, c: Column) -> Column:
        at = F.instr(F.lit(SYMBOLS), F.lower(c)) - 1
        case = F.when(c.between("A", "Z"), 0).when(c.between("a", "z"), 1).otherwise(2)
        turn = F.when(mixed & (case < 2), F.element_at(cases, a["case"] * 2 + case + 1)).otherwise(0.0)
        return F.struct((a["sum"] + F.element_at(table, a["at"] * len(SYMBOLS) + at + 1) + turn).alias("sum"),
                        at.cast("int").alias("at"), case.alias("case"))

    start = F.struct(F.lit(0.0).alias("sum"), F.lit(len(SYMBOLS)).alias("at"), F.lit(2).alias("case"))
    return F.aggregate(F.split(value, ""), start, step, lambda a: a["sum"])


def _let(x: Column, f) -> Column:
    """f(x) with x worked out once."""
    return F.transform(F.array(x), f)[0]


def _tests(given: Column, model: list[float]) -> Column:
    def codes(g: Column) -> Column:
        chars = F.split(g["value"], "")
        n, k = F.char_length(g["value"]).cast("double"), F.char_length(g["alphabet"]).cast("double")
        values = F.transform(chars, lambda c: (F.instr(g["alphabet"], c) - 1).cast("double"))
        squares = F.aggregate(F.array_distinct(chars), F.lit(0.0), lambda a, c: a + F.pow(
            n - F.char_length(F.replace(g["value"], c, F.lit(""))), F.lit(2.0)))
        return F.struct(g["encoding"].alias("encoding"), n.alias("n"), k.alias("k"), values.alias("v"), squares.alias("squares"),
                        _as_words(g["value"], model).alias("words"))

    def sums(c: Column) -> Column:
        n, middle = c["n"], (c["k"] - 1) / 2
        pairs = F.zip_with(F.slice(c["v"], F.lit(1), (n - 1).cast("int")), F.slice(c["v"], F.lit(2), (n - 1).cast("int")),
                           lambda x, y: F.struct(x.alias("x"), y.alias("y")))
        add = lambda over, f: F.aggregate(over, F.lit(0.0), lambda a, x: a + f(x))
        return F.struct(
            c["encoding"].alias("encoding"), n.alias("n"), c["k"].alias("k"), c["squares"].alias("squares"), c["words"].alias("words"),
            add(c["v"], lambda x: (x > middle).cast("double")).alias("high"),
            (add(pairs, lambda q: ((q["x"] > middle) != (q["y"] > middle)).cast("double")) + 1).alias("runs"),
            add(c["v"], lambda x: (x - middle) * (x - middle)).alias("spread"),
            add(pairs, lambda q: (q["x"] - middle) * (q["y"] - middle)).alias("product"))

    def verdict(s: Column) -> Column:
        n, k = s["n"], s["k"]
        chi = F.greatest(k / n * s["squares"] - n, F.lit(0.0))
        # Wilson and Hilferty's cube root, for the degrees of freedom that give the statistic its exact mean and variance:
        # short strings leave it skewed, and the plain normal tail would call too many of them uneven.
        ninths = 2 / (9 * (k - 1) * n / (n - 1))
        uniform = _one_sided((F.pow(chi / (k - 1), F.lit(1 / 3)) - (1 - ninths)) / F.sqrt(ninths))
        high, low = s["high"], n - s["high"]
        mean = 1 + 2 * high * low / n
        variance = 2 * high * low * (2 * high * low - n) / (n * n * (n - 1))
        runs = F.when(variance > 0, 2 * _upper_tail(F.abs(s["runs"] - mean) / F.sqrt(variance))).otherwise(F.pow(F.lit(0.5), n - 1))
        serial = F.when(s["spread"] > 0, 2 * _upper_tail(F.abs(s["product"] / s["spread"] + 1 / n) * F.sqrt(n))).otherwise(F.lit(0.0))
        words = F.pow(F.lit(2.0), -n * F.log2(k) - s["words"])
        return F.struct(s["encoding"].alias("encoding"), F.least(F.lit(1.0), 4 * F.least(uniform, runs, serial, words)).alias("p"))

    return _let(_let(_let(given, codes), sums), verdict)


def _bin(p: Column, weight: Column) -> Column:
    """Weighted p-value on the grid: bin b stands for 10 ** (-b / GRID), rounded up."""
    return F.least(F.lit(LAST_BIN), F.floor(-GRID * F.log10(F.least(F.lit(1.0), F.greatest(p / weight, F.lit(1e-300)))))).cast("int")


def rejected_from(counts: dict[int, int], rate: float) -> int:
    """First bin that Benjamini and Hochberg reject (all later ones with it); LAST_BIN + 1 if none."""
    total, passed, first = sum(counts.values()), 0, LAST_BIN + 1
    for b in sorted(counts, reverse=True):
        passed += counts[b]
        if 10 ** (-b / GRID) <= rate * passed / total:
            first = b
    return first


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = FALSE_DISCOVERY_RATE) -> DataFrame:
    """doc_id, base (spans), added (spans of kind ``random``), tested (candidates with encoding and p-value)."""
    text = text_or_empty(text_col)
    model = word_model(docs, text_col)
    candidates = sp.find(text, CANDIDATE, "random", 3, F.lit(True))
    found = docs.select(F.col(id_col).alias("doc_id"), base_spans(text).alias("base"), candidates.alias("candidates"))
    free = F.filter("candidates", lambda c: ~sp.overlaps(c, F.col("base")))
    found = materialise(found.select("doc_id", "base", F.transform(free, lambda c: F.struct(
        c.alias("span"), battery(c["value"], model).alias("test"))).alias("tested")), "secret-candidates")
    each = found.select(F.explode("tested").alias("t")).select(
        F.col("t.test.p").alias("p"), F.char_length("t.span.value").cast("double").alias("n"))
    mean = each.agg(F.avg("n")).first()[0] or 1.0
    # At most LAST_BIN + 1 rows come to the driver.
    counts = each.groupBy(_bin(F.col("p"), F.col("n") / F.lit(mean)).alias("bin")).count().collect()
    first = rejected_from({r["bin"]: r["count"] for r in counts}, rate)
    random = F.filter("tested", lambda t: _bin(t["test"]["p"], F.char_length(t["span"]["value"]) / F.lit(mean)) < first)
    return found.select("doc_id", "base", F.transform(random, lambda t: t["span"]).alias("added"), "tested")


def digests(found: DataFrame) -> DataFrame:
    base, everything = sp.by_start(F.col("base")), sp.by_start(F.concat("base", "added"))
    return found.select(
        "doc_id", *[sp.count_kind(F.col("base"), k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(sp.joined(base), 256).alias("base_sha256"), sp.joined(everything).alias("spans"))
