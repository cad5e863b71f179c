"""Text normalisation and tokens, as JVM column expressions; for the letters of most texts by Python as well."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# A word is two or more letters, digits or underscores in a row.
WORD = r"[\p{L}\p{N}_]{2,}"
# What lies between runs of them.
GAP = r"[^\p{L}\p{N}_]+"

_HANGUL_FIRST, _HANGUL_LAST = 0xAC00, 0xD7A3
# Conjoining letters in code point order; a syllable number splits into (lead, vowel, tail).
_LEADS = "".join(chr(0x1100 + i) for i in range(19))
_VOWELS = "".join(chr(0x1161 + i) for i in range(21))
_TAILS = "".join(chr(0x11A8 + i) for i in range(27))
_SEPARATOR = "\u0000"


def strip(text: Column) -> Column:
    """Remove white space of every kind at both ends."""
    return F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", "")


@lru_cache(maxsize=1)
def _folding() -> tuple[str, str, str]:
    """(class matching characters that fold, those characters, their folded forms).

    Derived from the Unicode compatibility decomposition without combining marks. Hangul
    syllables are left out here: they decompose by arithmetic.
    """
    keys, values = [], []
    for point in range(0x80, 0x110000):
        if 0xD800 <= point <= 0xDFFF or _HANGUL_FIRST <= point <= _HANGUL_LAST:
            continue
        char = chr(point)
        folded = "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))
        if folded != char:
            keys.append(char)
            values.append(folded)
    spans, start = [], None
    points = [ord(c) for c in keys] + [None]
    for here, following in zip(points, points[1:]):
        start = here if start is None else start
        if following != here + 1:
            spans.append(rf"\x{{{start:X}}}-\x{{{here:X}}}")
            start = None
    spans.append(rf"\x{{{_HANGUL_FIRST:X}}}-\x{{{_HANGUL_LAST:X}}}")
    return f"[{''.join(spans)}]", "".join(keys), _SEPARATOR.join(values)


def _folded_char(char: Column) -> Column:
    _, keys, values = _folding()
    syllable = F.ascii(char) - F.lit(_HANGUL_FIRST)
    tail = F.pmod(syllable, F.lit(28))
    hangul = F.concat(
        F.substring(F.lit(_LEADS), F.floor(syllable / 588).cast("int") + 1, F.lit(1)),
        F.substring(F.lit(_VOWELS), F.floor(F.pmod(syllable, F.lit(588)) / 28).cast("int") + 1, F.lit(1)),
        F.when(tail > 0, F.substring(F.lit(_TAILS), tail, F.lit(1))).otherwise(F.lit("")),
    )
    looked_up = F.element_at(
        F.split(F.lit(values), _SEPARATOR),
        F.call_function("locate", char, F.lit(keys)),
    )
    return F.when(F.ascii(char).between(_HANGUL_FIRST, _HANGUL_LAST), hangul).otherwise(looked_up)


def fold(text: Column) -> Column:
    """Lower case without accents. Only the distinct foldable characters of a text are replaced."""
    pattern, _, _ = _folding()
    lowered = F.lower(text)
    foreign = F.array_distinct(F.regexp_extract_all(lowered, F.lit(r"[^\x00-\x7F]"), F.lit(0)))
    return F.aggregate(
        F.filter(foreign, lambda char: F.rlike(char, F.lit(pattern))),
        lowered,
        lambda acc, char: F.replace(acc, char, _folded_char(char)),
    )


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(fold(text), F.lit(WORD), F.lit(0))


# What is none of these is left to the JVM, whose Unicode version may differ from that of Python.
_COMMON = [*range(0x180), *range(0x2010, 0x2028), 0x20AC]
# A class of several ranges is slow: what is in none of the further ones is looked at by itself.
_RARE = r"[^\x00-\x{17F}](?<![\x{2010}-\x{2027}\x{20AC}])"
_ASCII_GAP = bytes(c if c > 127 or chr(c).isalnum() or c == 95 else 32 for c in range(256))


def common_words(text: Column) -> tuple[Column, Column]:
    """(text, whether its words are made): words one blank apart for a text with rare characters, else the text itself,
    of which ``words_apart`` makes the same words at a fraction of the time."""
    rare = F.coalesce(F.rlike(text, F.lit(_RARE)), F.lit(False))
    return F.when(rare, spaced_words(text)).otherwise(text), rare


def spaced_words(text: Column) -> Column:
    """The folded text, with a blank for all that is between words."""
    return F.regexp_replace(fold(text), GAP, " ")


@lru_cache(maxsize=1)
def _common_folding() -> dict[str, str]:
    """What each common character beyond ASCII becomes in a word."""
    folded = {}
    # The dot above is what lower case makes of a capital i with one.
    for char in map(chr, [*_COMMON[128:], 0x307]):
        plain = (c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))
        folded[char] = "".join(c if c == "_" or unicodedata.category(c)[0] in "LN" else " " for c in plain)
    return folded


def words_apart(text: bytes) -> bytes:
    """Folded words, single letters included, one blank apart, of a text with common characters only."""
    lowered = text.lower()
    if not text.isascii():
        signs = text.decode().lower()
        for char in {c for c in set(signs) if c > "\x7f"}:
            signs = signs.replace(char, _common_folding()[char])
        lowered = signs.encode()
    return b" ".join(lowered.translate(_ASCII_GAP).split())


def grams(words: Column) -> Column:
    """Every word and every pair of neighbouring words."""
    pairs = F.greatest(F.size(words) - 1, F.lit(0))
    neighbours = F.zip_with(
        F.slice(words, F.lit(1), pairs),
        F.slice(words, F.lit(2), pairs),
        lambda left, right: F.concat(left, F.lit(" "), right),
    )
    return F.concat(words, neighbours)


def article_text(title: Column, body: Column) -> Column:
    """Title and body. Blanks at the ends stay: they make no words."""
    return F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(body, F.lit("")))


def truncate(text: Column, size: int) -> Column:
    return F.substring(text, 1, size)


def escape_html(text: Column) -> Column:
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text
