"""Text cleaning as Column expressions; no step leaves the JVM.

Java's ``\\w`` and ``\\S`` are ASCII-only, so word and space characters are spelled out as
Unicode classes. ``(?d)`` makes the dot match a carriage return.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tonemill.constants import MASK, PUNCTUATION, SPELLING, URL_MASK

SPACE = r"\s\x1c-\x1f\x85\p{Z}"
WORD = r"\p{L}\p{N}_"


def lowercase(c: Column) -> Column:
    return F.lower(c)


def mask_mentions(c: Column) -> Column:
    """``@name`` becomes ``X``; a bare ``@`` stays."""
    return F.regexp_replace(c, f"@[^{SPACE}]+", MASK)


def mask_urls(c: Column) -> Column:
    """``http...`` up to the next space becomes ``http``."""
    return F.regexp_replace(c, f"http[^{SPACE}]+", URL_MASK)


def mask_hashtags(c: Column) -> Column:
    return F.regexp_replace(c, f"#[^{SPACE}]+", MASK)


def strip_punct(c: Column) -> Column:
    """Each ASCII punctuation character except the apostrophe becomes one space."""
    return F.translate(c, PUNCTUATION, " " * len(PUNCTUATION))


def join_apostrophes(c: Column) -> Column:
    """``don't`` becomes ``dont``; pairs do not overlap, so ``rock'n'roll`` keeps its second one.

    The search starts from the apostrophe, which is rare. An apostrophe right after the second
    word is consumed with it and put back: its left neighbour is already part of a pair.
    """
    return F.regexp_replace(c, f"'(?<=[{WORD}]')([{WORD}]++)('?)", "$1$2")


def strip_non_ascii(c: Column) -> Column:
    return F.regexp_replace(c, r"[^\x00-\x7F]+", "")


def collapse_repeats(c: Column) -> Column:
    """A character three or more times in a row is written once; exactly two stay."""
    return F.regexp_replace(c, r"(?d)(.)\1{2,}", "$1")


def collapse_spaces(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, f"[{SPACE}]+", " "))


def collapse_ascii_spaces(c: Column) -> Column:
    """The same for text without non-ASCII characters, at half the cost."""
    return F.trim(F.regexp_replace(c, r"[\s\x1c-\x1f]+", " "))


def fix_spelling(c: Column, corrections: dict[str, str] = SPELLING) -> Column:
    """Replace whole words, one entry after the other.

    ``\\b`` follows Java's rules here, so the input should be ASCII, as it is in every profile.
    The boundary on the left is checked last, so that the search is for a plain string.
    """
    return reduce(
        lambda x, kv: F.regexp_replace(x, rf"{kv[0]}\b(?<=\b{kv[0]})", kv[1]),
        corrections.items(), c)


PROFILES = {
    "frequency": [lowercase, mask_mentions, mask_urls, strip_punct, join_apostrophes,
                  strip_non_ascii, collapse_repeats, collapse_ascii_spaces],
    "embedding": [lowercase, mask_mentions, mask_urls, mask_hashtags, strip_punct,
                  join_apostrophes, strip_non_ascii, collapse_repeats, collapse_ascii_spaces],
    "contextual": [lowercase, mask_mentions, mask_urls, strip_non_ascii],
}


def clean_text(c: Column, profile: str = "frequency",
               corrections: dict[str, str] = SPELLING) -> Column:
    """One of the three cleaning profiles as a single expression."""
    return fix_spelling(reduce(lambda x, step: step(x), PROFILES[profile], c), corrections)
