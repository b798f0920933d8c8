"""Tokenisers and string rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The five separators of a plain tokeniser, and the pattern of a kept token.
SPACE_SEPARATORS = "[ \\t\\n\\r\\f]+"
LETTERS_ONLY = "^[a-zA-Z]+\\z"
NON_LETTERS = "[^a-zA-Z]+"


def space_tokens(text: Column) -> Column:
    """Tokens between blanks, tabs, newlines, carriage returns and form feeds."""
    return F.split(text, SPACE_SEPARATORS)


def is_letters(token: Column) -> Column:
    """True for a token made of ASCII letters only."""
    return token.rlike(LETTERS_ONLY)


def kept_tokens(text: Column) -> Column:
    """Lower-cased letter-only tokens in order; any other token is dropped whole."""
    return F.transform(F.filter(space_tokens(text), is_letters), F.lower)


def letter_words(text: Column) -> Column:
    """Runs of ASCII letters; the array may carry empty strings at its ends."""
    return F.split(text, NON_LETTERS)


def path_segment(identifier: Column, position: int) -> Column:
    """Segment of a ``/`` separated identifier, counted from 0; NULL if there is none."""
    return F.get(F.split(identifier, "/"), F.lit(position))


def contains_flag(identifier: Column, marker: str) -> Column:
    """1 where the identifier contains the marker (case-sensitive), else 0."""
    return F.when(F.contains(identifier, F.lit(marker)), F.lit(1)).otherwise(F.lit(0))


def is_blank(line: Column) -> Column:
    """True for a line that is empty or white space only."""
    return F.length(F.regexp_replace(line, "(?U)\\s+", "")) == 0


def month_name(when: Column) -> Column:
    """Full English month name."""
    return F.date_format(when, "MMMM")


def char_codes(line: Column) -> Column:
    """Code points of a line, without those of 256 and above."""
    codes = F.transform(F.filter(F.split(line, ""), lambda c: c != ""), F.ascii)
    return F.filter(codes, lambda c: c < 256)


def pad_left(codes: Column, length: Column, filler: int = -1) -> Column:
    """Prefix a code array with ``filler`` up to a common length."""
    return F.concat(F.array_repeat(F.lit(filler), F.greatest(length - F.size(codes), F.lit(0))), codes)
