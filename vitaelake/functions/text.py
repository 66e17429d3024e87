"""Text expressions. All stay in the JVM and inside code generation."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitaelake.config import (
    EMAIL_SEARCH_PATTERN,
    PHONE_SEARCH_PATTERN,
    SNIPPET_CHARS,
    Lexicon,
)

# Every whitespace run but the single space, which needs no replacement: two or
# more characters, or one that is no space.
_WHITESPACE_RUN = r"\s(?:\s++|(?<! ))"


def clean_text(raw: Column) -> Column:
    """Collapse whitespace runs to one space and trim; NULL stays NULL."""
    return F.trim(F.regexp_replace(raw, _WHITESPACE_RUN, " "))


def is_unreadable(raw: Column, min_words: int = 1) -> Column:
    """True for NULL text and for text of fewer than ``min_words`` words.

    Works on the raw text and stops reading at word ``min_words``, so a branch
    that needs no clean text does not compute it. Never NULL.
    """
    if min_words < 1:
        raise ValueError("min_words must be at least 1")
    enough = r"\S" if min_words == 1 else rf"^\s*+(?:\S++\s++){{{min_words - 1}}}\S"
    return raw.isNull() | ~raw.rlike(enough)


def word_count(clean: Column) -> Column:
    """Words of a text that ``clean_text`` produced, counted by its spaces."""
    # A space is one byte, and bytes need no decoding.
    gapless = F.octet_length(F.replace(clean, F.lit(" "), F.lit("")))
    return F.octet_length(clean) - gapless + F.lit(1)


def _is_word(ch: str) -> bool:
    return ch == "_" or ch.isalnum()


def _edge(text: str, at: int) -> bool:
    return _is_word(text[at - 1]) != _is_word(text[at])


def terms_can_overlap(terms: Sequence[str]) -> bool:
    """Whether two matches of the terms can share characters of a text.

    If none can, one scan with an alternation counts what the sum of one scan
    per term counts.
    """
    for a in terms:
        for b in terms:
            for start in range(len(a)):
                if start == 0 and a == b:
                    continue
                if start > 0 and not _edge(a, start):
                    continue
                rest = a[start:]
                shared = min(len(rest), len(b))
                if rest[:shared] != b[:shared]:
                    continue
                longer = max(rest, b, key=len)
                if shared == len(longer) or _edge(longer, shared):
                    return True
    return False


def _term_pattern(terms: Sequence[str]) -> str:
    # The first-letter test is cheap and spares the word-border test at most
    # positions. (?U) pins the Unicode word border, which JDK releases differ on.
    firsts = "".join(sorted({re.escape(t[0]) for t in terms}))
    body = "|".join(re.escape(t) for t in terms)
    return rf"(?U)(?=[{firsts}])\b(?:{body})\b"


def _one_scan(terms: Sequence[str]) -> bool:
    """Whether a single alternation counts the terms as one scan each would."""
    return len(set(terms)) == len(terms) and not terms_can_overlap(terms)


def _lowered(terms: Sequence[str]) -> list[str]:
    if any(not t for t in terms):
        raise ValueError("a term must not be empty")
    return [t.lower() for t in terms]


def term_hits(text: Column, terms: Sequence[str]) -> Column:
    """Whole-word, case-blind hits of all terms in the text."""
    terms = _lowered(terms)
    if not terms:
        return F.lit(0)
    groups = [terms] if _one_scan(terms) else [[t] for t in terms]
    counts = [F.regexp_count(F.lower(text), F.lit(_term_pattern(g))) for g in groups]
    return reduce(lambda x, y: x + y, counts)


def lexicon_score(text: Column, lexicon: Lexicon) -> Column:
    """Hits of the raising terms minus hits of the lowering terms."""
    plus, minus = _lowered(lexicon.plus), _lowered(lexicon.minus)
    if not plus or not minus or not _one_scan(plus + minus):
        return term_hits(text, plus) - term_hits(text, minus)
    # The text is scanned once for both sides; the few hits are then told apart.
    pattern = F.lit(_term_pattern(plus + minus))
    hits = F.regexp_extract_all(F.lower(text), pattern, F.lit(0))
    raising = reduce(F.array_remove, minus, hits)
    return F.size(raising) * 2 - F.size(hits)


def has_email(text: Column) -> Column:
    return text.contains("@") & text.rlike(EMAIL_SEARCH_PATTERN)


def has_phone(text: Column) -> Column:
    return text.rlike(PHONE_SEARCH_PATTERN)


def snippet(text: Column, chars: int = SNIPPET_CHARS) -> Column:
    """First characters of the text, ``''`` for NULL."""
    return F.substring(F.coalesce(text, F.lit("")), 1, chars)


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits, as an array."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{M}\p{N}]+"), "")


def ascii_separated(text: Column) -> Column:
    """The text in lower case, where between two of its words is an ASCII character.

    Other characters that are no part of a word become spaces. As these are rare, the
    pattern is told from ASCII first.
    """
    return F.regexp_replace(F.lower(text), r"[\x{80}-\x{10FFFF}&&[^\p{L}\p{M}\p{N}]]+", " ")


# Markup that carries no text, then the entities; the ampersand comes last so
# that "&amp;lt;" stays the text "&lt;".
_MARKUP = (
    r"(?is)<script\b[^>]*>.*?</script\s*>",
    r"(?is)<style\b[^>]*>.*?</style\s*>",
    r"(?s)<!--.*?-->",
    r"(?s)<[^>]*>",
)
_ENTITIES = (
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&nbsp;", " "),
    ("&amp;", "&"),
)


def html_text(html: Column) -> Column:
    """Visible text of an HTML page, with native regular expressions."""
    text = reduce(lambda c, p: F.regexp_replace(c, p, " "), _MARKUP, html)
    for entity, character in _ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(character))
    return clean_text(text)
