"""Scalar text functions as column expressions (no Python worker in any of them)."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# These strings and lengths decide file names and links, so they must not change.
WATCH_URL_PREFIX = "https://www.youtube.com/watch?v="
FILE_NAME_CHARS = 60
PREVIEW_TITLE_CHARS = 55
PREVIEW_TEXT_CHARS = 80
DOCUMENT_LABELS = ("Title: ", "Video URL: ", "Channel: ", "Published: ", "Total Comments Fetched: ")
DOCUMENT_COMMENTS_MARK = "COMMENTS:"
REPLY_MARK = "  -> "

# Unicode white space plus the four ASCII separators, which Java's \s leaves out.
_SPACE = r"\s\x1c-\x1f"
_TOKEN_BREAK = r"[^a-z']+"
# Possessive, as a run of breaks never has to be given back: the same words, a fifth faster.
_WORD_BREAK = r"[^\p{L}\p{M}\p{N}']++"


def strip_whitespace(c: Column) -> Column:
    """Drop white space of any kind at both ends (``F.trim`` drops only U+0020)."""
    return F.regexp_replace(c, rf"(?U)^[{_SPACE}]+|[{_SPACE}]+$", "")


def channel_handle(raw: Column) -> Column:
    """Stripped handle with exactly the leading ``@`` it had, or one added."""
    h = strip_whitespace(raw)
    return F.when(h.startswith("@"), h).otherwise(F.concat(F.lit("@"), h))


def channel_slug(handle: Column) -> Column:
    """Folder name of a channel: all leading ``@`` dropped, ``/`` turned into ``_``."""
    return F.replace(F.regexp_replace(handle, "^@+", ""), F.lit("/"), F.lit("_"))


def video_url(video_id: Column) -> Column:
    return F.concat(F.lit(WATCH_URL_PREFIX), video_id)


def sanitise_title(title: Column, max_chars: int = FILE_NAME_CHARS) -> Column:
    """Letters, digits, ``_``, ``-`` and single ``_`` for each run of white space, cut to length."""
    kept = strip_whitespace(F.regexp_replace(title, rf"(?U)[^\p{{L}}\p{{N}}_{_SPACE}\-]", ""))
    return F.substring(F.regexp_replace(kept, rf"(?U)[{_SPACE}]+", "_"), 1, max_chars)


def preview(c: Column, chars: int) -> Column:
    return F.substring(c, 1, chars)


def comment_line(author: Column, text: Column, likes: Column) -> Column:
    """``[author]: text (likes: n)``; a missing part is left empty, so the line itself never is."""
    a, t, n = (F.coalesce(c.cast("string"), F.lit("")) for c in (author, text, likes))
    return F.concat(F.lit("["), a, F.lit("]: "), t, F.lit(" (likes: "), n, F.lit(")"))


def tokens(text: Column) -> Column:
    """Lower-case tokens of a-z and ``'``, as word lists use them; empty strings can stand at the ends."""
    return F.split(F.lower(text), _TOKEN_BREAK)


def words(text: Column) -> Column:
    """Lower-case words of any script: runs of letters, marks, digits and ``'``."""
    return F.array_remove(F.split(F.lower(text), _WORD_BREAK), "")


def holds_any(text: Column, terms: Sequence[str]) -> Column:
    """Whether one of the terms occurs anywhere in the text, in any case; much cheaper than splitting it.

    The lower-case text is bound to a lambda variable: otherwise it would be made again for every term.
    """
    return F.exists(F.array(F.lower(text)), lambda low: reduce(lambda a, b: a | b, [low.contains(t.lower()) for t in terms]))


def search_words(query: Sequence[str]) -> list[str]:
    """Distinct lower-case search words; each must be one word in the sense of :func:`words`."""
    found = list(dict.fromkeys(w.lower() for w in query))
    for w in found:
        if not w or any(c != "'" and unicodedata.category(c)[0] not in "LMN" for c in w):
            raise ValueError(f"not a single word: {w!r}")
    return found


def term_frequencies(text: Column, split: Callable[[Column], Column] = words) -> Column:
    """``array<struct<term, tf>>`` of one text, whose terms are what ``split`` makes of it.

    Tokens are sorted and the runs measured, so counting needs no shuffle and one pass after the sort.
    Arrays that are used more than once are bound to lambda variables.
    """
    def run_starts(toks: Column) -> Column:
        marked = F.transform(toks, lambda t, i: F.struct(
            t.alias("term"), i.alias("pos"), (F.coalesce(F.get(toks, i - 1) != t, F.lit(True))).alias("first")))
        return F.filter(marked, lambda m: m["first"])

    def lengths(starts: Column, n: Column) -> Column:
        return F.transform(starts, lambda s, j: F.struct(
            s["term"].alias("term"), (F.coalesce(F.get(starts, j + 1)["pos"], n) - s["pos"]).alias("tf")))

    def counted(toks: Column) -> Column:
        return F.transform(F.array(run_starts(toks)), lambda starts: lengths(starts, F.size(toks)))[0]

    return F.transform(F.array(F.sort_array(split(text))), counted)[0]


def word_count(text: Column) -> Column:
    """White-space separated words."""
    return F.size(F.array_remove(F.split(text, rf"(?U)[{_SPACE}]+"), ""))
