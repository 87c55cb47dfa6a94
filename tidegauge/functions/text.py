"""Splitting and tokenising text fields."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The blanks that separate words, and those a single "\s" separator matches.
WORD_BLANKS = " \t\n\r\f"
SPACE_CLASS = " \t\n\x0b\f\r"


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _no_strings() -> Column:
    return F.array().cast("array<string>")


def split_fields(text: Column | str, separator: str) -> Column:
    """Split on one separator character; trailing empty fields are dropped.

    Leading and inner empty fields stay, ``''`` gives one empty field and a text made of
    separators alone gives none. Spark's ``split`` keeps trailing empties at every limit, so
    the trailing run is trimmed first.
    """
    text = as_column(text)
    kept = F.rtrim(text, F.lit(separator))
    return F.when((kept == "") & (text != ""), _no_strings()).otherwise(
        F.split(kept, re.escape(separator), -1)
    )


def split_blanks(text: Column | str) -> Column:
    """Split at every single whitespace character; trailing empty fields are dropped."""
    text = as_column(text)
    kept = F.rtrim(text, F.lit(SPACE_CLASS))
    return F.when((kept == "") & (text != ""), _no_strings()).otherwise(
        F.split(kept, f"[{SPACE_CLASS}]", -1)
    )


def words(text: Column | str) -> Column:
    """Whitespace-separated words, never empty ones."""
    core = F.trim(as_column(text), F.lit(WORD_BLANKS))
    return F.when(core == "", _no_strings()).otherwise(F.split(core, f"[{WORD_BLANKS}]+", -1))


def lines(text: Column | str) -> Column:
    """Non-empty lines of a multi-line record."""
    core = F.trim(as_column(text), F.lit("\n"))
    return F.when(core == "", _no_strings()).otherwise(F.split(core, "\n+", -1))


def field(parts: Column, index: int) -> Column:
    """Field by position, NULL when the record is too short."""
    return F.get(parts, F.lit(index))


def to_long(text: Column | str) -> Column:
    """Whole decimal number or NULL (no blanks, no fraction)."""
    text = as_column(text)
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("bigint"))


def second_key(text: Column | str) -> Column:
    """First ten characters (the seconds of a 13-digit millisecond stamp), NULL if shorter."""
    text = as_column(text)
    return F.when(F.length(text) >= 10, F.substring(text, 1, 10))


def char_from_end(text: Column | str, position: int) -> Column:
    """Character counted from the end (1 = last), NULL when the text is shorter."""
    text = as_column(text)
    return F.when(F.length(text) >= position, F.substring(text, -position, 1))


def reverse_words(text: Column | str) -> Column:
    """Words separated by single spaces, in reverse order."""
    return F.array_join(F.reverse(split_fields(text, " ")), " ")
