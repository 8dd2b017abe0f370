"""The randomness battery of the secret scans in plain Python: exact normal tails, no grid but the one of the decision."""

import math
import re

LOW, UP, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
SYMBOLS = LOW + DIGITS + "+/_-"
RUN = re.compile(r"[A-Za-z0-9+/_-]+")
ENCODINGS = [("[0-9]+", DIGITS), ("[0-9a-f]+", DIGITS + "abcdef"), ("[0-9A-F]+", DIGITS + "ABCDEF"), ("[A-Z]+", UP), ("[a-z]+", LOW),
             ("[A-Za-z]+", UP + LOW), ("[0-9A-Z]+", DIGITS + UP), ("[0-9a-z]+", DIGITS + LOW), ("[0-9A-Za-z]+", UP + LOW + DIGITS),
             ("[0-9A-Za-z+/]+", UP + LOW + DIGITS + "+/"), (".*", UP + LOW + DIGITS + "-_+/")]


def tail(z):
    return math.erfc(z / math.sqrt(2)) / 2


def word_chances(texts):
    """(symbol before or '', symbol) -> probability, over the different runs of under 16 characters."""
    seen = {}
    for w in {w for t in texts for w in RUN.findall(t) if len(w) < 16}:
        for a, b in zip([""] + list(w.lower()), w.lower()):
            seen[a, b] = seen.get((a, b), 0) + 1
    size, chance = len(SYMBOLS), {}
    for a in ["", *SYMBOLS]:
        total = sum(seen.get((a, b), 0) for b in SYMBOLS)
        for b in SYMBOLS:
            chance[a, b] = 0.9 * (seen.get((a, b), 0) + 0.5) / (total + 0.5 * size) + 0.1 / size
    return chance


def p_value(value, chance):
    alphabet = next(letters for pattern, letters in ENCODINGS if re.fullmatch(pattern, value))
    n, k = len(value), len(alphabet)
    v = [alphabet.index(c) for c in value]
    middle = (k - 1) / 2
    chi = max(0.0, k / n * sum(value.count(c) ** 2 for c in set(value)) - n)
    ninths = 2 / (9 * (k - 1) * n / (n - 1))
    uniform = tail(((chi / (k - 1)) ** (1 / 3) - (1 - ninths)) / math.sqrt(ninths))
    above = [x > middle for x in v]
    high = sum(above)
    low, runs = n - high, 1 + sum(a != b for a, b in zip(above, above[1:]))
    mean, variance = 1 + 2 * high * low / n, 2 * high * low * (2 * high * low - n) / (n * n * (n - 1))
    by_runs = 2 * tail(abs(runs - mean) / math.sqrt(variance)) if variance > 0 else 0.5 ** (n - 1)
    spread = sum((x - middle) ** 2 for x in v)
    product = sum((x - middle) * (y - middle) for x, y in zip(v, v[1:]))
    serial = 2 * tail(abs(product / spread + 1 / n) * math.sqrt(n)) if spread > 0 else 0.0
    words, before, case = 0.0, "", 2
    mixed = any(c in UP for c in value) and any(c in LOW for c in value)
    for c in value:
        words += math.log2(chance[before, c.lower()])
        now = 0 if c in UP else 1 if c in LOW else 2
        if mixed and now < 2:
            words += math.log2(((0.5, 0.5), (0.1, 0.9), (0.5, 0.5))[case][now])
        before, case = c.lower(), now
    return min(1.0, 4 * min(uniform, by_runs, serial, 2.0 ** min(0.0, -n * math.log2(k) - words)))


def random_spans(texts, base, rate=0.01):
    """Per text the (start, end) of the candidates that are not found to be plain.  ``base``: (start, end) per text."""
    chance = word_chances(texts)
    found = [(i, m.start(), m.end(), p_value(m[0], chance)) for i, t in enumerate(texts) for m in RUN.finditer(t)
             if len(m[0]) >= 16 and not any(s < m.end() and m.start() < e for s, e in base[i])]
    if not found:
        return [[] for _ in texts], {}
    mean = sum(e - s for _, s, e, _ in found) / len(found)
    bins = [min(300, math.floor(-10 * math.log10(min(1.0, max(p / ((e - s) / mean), 1e-300))))) for _, s, e, p in found]
    first = 301
    for b in sorted(set(bins), reverse=True):
        if 10 ** (-b / 10) <= rate * sum(x >= b for x in bins) / len(bins):
            first = b
    out = [[] for _ in texts]
    for (i, s, e, _), b in zip(found, bins):
        if b < first:
            out[i].append((s, e))
    return out, {(i, s, e): p for i, s, e, p in found}
