"""Plain Python versions of the contracts: row by row, nothing shared with the library."""

import hashlib
import re
import zlib
from collections import Counter
from itertools import accumulate

import sentencepiece
from public_tokenizers import path
from tokenizers import Tokenizer

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(s):
    return hashlib.sha256(s if isinstance(s, bytes) else s.encode()).hexdigest()


def op1(docs):
    t = Tokenizer.from_file(path("word_bpe_49k.json"))
    docs = sorted(docs, key=lambda d: d[0])
    ids = [t.encode(x or "", add_special_tokens=False).ids + [1] for _, x in docs]
    starts = [0, *accumulate(map(len, ids))]
    return [(d, s, len(i), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in i))) for (d, _), s, i in zip(docs, starts, ids)]


def spans2(x):
    assign = [m for m in re.finditer(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", x)
              if len(m[2]) >= 6]
    access = [m for m in re.finditer("AKIA[A-Z0-9]+", x) if len(m[0]) >= 20]
    hexes = [m for m in re.finditer("[0-9a-f]+", x) if len(m[0]) >= 24]
    return [("assign", assign), ("access", access), ("hex", hexes)]


def op2(docs):
    out = []
    for d, x in docs:
        found = spans2(x or "")
        every = sorted((m.start(), i, m.end(), k) for i, (k, ms) in enumerate(found) for m in ms)
        out.append((d, *[len(ms) for _, ms in found], sha(",".join(f"{k}:{a}:{b}" for a, _, b, k in every))))
    return out


def luhn(s):
    d = [int(c) for c in s if c.isdigit()][::-1]
    return 13 <= len(d) <= 19 and sum(sum(divmod(2 * v, 10)) if i % 2 else v for i, v in enumerate(d)) % 10 == 0


def op9(docs):
    out = []
    for d, x in docs:
        x = x or ""
        found = [
            ("email", list(re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", x))),
            ("ip", [m for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", x) if all(int(p) <= 255 for p in m[0].split("."))]),
            ("card", [m for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", x) if luhn(m[0])]),
            ("phone", [m for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", x) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]),
        ]
        out.append((d, *[len(ms) for _, ms in found], sha(",".join(f"{k}:{m.start()}:{m.end()}" for k, ms in found for m in ms))))
    return out


def shingles(x, n=3):
    w = WORD.findall((x or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)])


def components(docs, n=3, percent=90):
    sets = [shingles(x, n) for _, x in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        least[find(i)] = min(d, least.get(find(i), d))
    return [(d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(docs)]


def op4(docs, k=200):
    raw = [(d, (x or "").encode()) for d, x in docs]
    seen = Counter(b[i:i + k] for _, b in raw for i in range(len(b) - k + 1))
    out = []
    for d, b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - k + 1):
            if seen[b[i:i + k]] > 1:
                gone[i:i + k] = b"\1" * k
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((d, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(kept)))
    return out


def op5(docs):
    out = []
    for d, x in docs:
        x = x or ""
        w = WORD.findall(x)
        times = Counter(zip(w, w[1:], w[2:]))
        at = set()
        for i, t in enumerate(zip(w, w[1:], w[2:])):
            if times[t] > 1:
                at |= {i, i + 1, i + 2}
        lines = [s for s in x.split("\n") if WORD.search(s)]
        bad = len(w) < 50 or 100 * len(at) > 50 * len(w)
        out.append((d, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", x)), len(lines) - len(set(lines)), len(at), bad))
    return out


def op6(docs):
    groups = {}
    for d, x in docs:
        groups.setdefault((x or "").translate(LOWER), []).append(d)
    return [(d, max(groups[t]), len(groups[t]), d == max(groups[t]), sha(t)) for d, x in docs for t in [(x or "").translate(LOWER)]]


def op8(docs):
    sp = sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))
    out = []
    for d, x in docs:
        ids = sp.encode(x or "")
        out.append((d, len(ids), sha(",".join(map(str, ids))), sha(sp.decode(ids))))
    return out


def targets(docs):
    """source -> (size, target), by resharing the excess until no target is above twice its source."""
    size = {}
    for _, x, s in docs:
        size[s] = size.get(s, 0) + len(WORD.findall(x or ""))
    names = sorted((s for s in size if s is not None)) + [s for s in size if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, left = dict.fromkeys(names, 0.0), 1.5 * sum(size.values())
    open_ = set(names)
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += left * weight[s] / total
        left = 0.0
        for s in list(open_):
            if target[s] >= 2 * size[s]:
                left += target[s] - 2 * size[s]
                target[s] = 2.0 * size[s]
                open_.discard(s)
    return {s: (size[s], target[s]) for s in names}


def op7(docs, rule="largest"):
    """docs: doc_id, text, lang, source -> doc_id, section, n_bytes, n_tokens, crossing."""
    import base64

    import public_tokenizers
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path("byte_bpe_50k.tiktoken"), "rb"))}
    e = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = []
    for d, x, *fields in docs:
        parts = [(f or "") + "\n" for f in fields] + ([] if x is None else [p + "\n" for p in x.split("\n")])
        if x is not None:
            parts[-1] = parts[-1][:-1]
        owner = [i for i, p in enumerate(parts) for _ in p.encode()]
        n, cross, at = [0] * len(parts), [0] * len(parts), 0
        for t in e.encode_ordinary("".join(parts)):
            own = owner[at:at + len(e.decode_single_token_bytes(t))]
            at += len(own)
            times = Counter(own)
            for s, k in times.items():
                cross[s] += len(times) > 1
                if rule == "share":
                    n[s] += k / len(own)
            if rule != "share":
                n[own[0] if rule == "first" else min(times, key=lambda s: (-times[s], s))] += 1
        out += [(d, i, len(p.encode()), n[i], cross[i]) for i, p in enumerate(parts)]
    return out


def runs(words, min_words=12, min_periods=2):
    """Every run by its definition: all stretches at all lags, those kept whose smallest period is the lag."""
    out, n = [], len(words)
    for q in range(1, n // min_periods + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            piece = words[i:j + q]
            if len(piece) >= max(min_words, min_periods * q) and not any(piece[d:] == piece[:-d] for d in range(1, q)):
                out.append((i, len(piece), q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def looped(d, x):
    w = WORD.findall(x or "")
    n = len(w)
    h = zlib.crc32(str(d).encode()) if d is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def op11(docs):
    out = []
    for d, x in docs:
        w = looped(d, x)
        found = runs(w)
        gone = {i for s, n, q in found for i in range(s + q, s + n)}
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        out.append((d, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha(lines),
                    sha(" ".join(v for i, v in enumerate(w) if i not in gone))))
    return out


def op12(docs):
    t = Tokenizer.from_file(path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in own}
    byte |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in byte.values())}
    entry = {i: bytes(byte.get(c, 0) for c in s) for s, i in t.get_vocab().items()}
    rows, seen = [], Counter()
    for d, x in docs:
        a, b = t.encode(" " + (x or ""), add_special_tokens=False).ids, sp.encode(x or "")
        ba = [entry[i] for i in a]
        bb = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [sp.id_to_piece(i)]]
        raw = (" " + (x or "")).encode()
        if not x or b"".join(ba) != raw or b"".join(bb) != raw:
            rows.append((d, [], [], [], []))
            continue
        ea, eb = list(accumulate(map(len, ba))), list(accumulate(map(len, bb)))
        links, j = [], 0
        for i, e in enumerate(ea):
            s = e - len(ba[i])
            while eb[j] <= s:
                j += 1
            k = j
            while k < len(b) and eb[k] - len(bb[k]) < e:
                links.append((a[i], b[k]))
                k += 1
        groups, i, j = [], 0, 0
        for cut in sorted(set(ea) & set(eb)):
            x2, y2 = ea.index(cut, i) + 1, eb.index(cut, j) + 1
            groups.append(",".join(map(str, a[i:x2])) + "|" + ",".join(map(str, b[j:y2])))
            i, j = x2, y2
        rows.append((d, a, b, groups, links))
        seen.update(set(links))
    most = {}
    for (x, _), n in seen.items():
        most[x] = max(most.get(x, 0), n)
    return [(d, len(a), len(b), len(g), len(k), sum(seen[p] == most[p[0]] for p in k), sum(seen[p] for p in k),
             sha(";".join(g)) if a else "") for d, a, b, g, k in rows]
